"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first `length` bytes, by passes from the most
significant digit; a suffix that is alone in its group leaves, and what is left in groups after
the last digit are exactly the repeated windows. Digits are taken where the window's content
says, so that neighbouring suffixes share them and one row stands for a run of suffixes:

1. the core: the bytes around the window's anchor, which is the position of the smallest hash of
   eight bytes in the window's middle zone; the suffixes with one anchor form a run;
2. the run: all bytes of all windows of the run, so that runs repeated as a whole are settled;
3. the bucket: the bytes that STEP neighbouring windows of a run have in common;
4. the whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, written

LENGTH = 400
#: Width of the zone in a window's middle where its anchor may lie.
ZONE = 200
#: Windows of a run that share a digit of the third pass.
STEP = 16
#: Long texts are taken in pieces of so many windows.
PIECE = 1 << 20
POSITION_BITS = 21
#: A run repeated by more than one in so many rows (and over HEAVY_ROWS times) is matched by a broadcast: there are at most so many.
HEAVY_KINDS, HEAVY_ROWS = 10_000, 1000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def _anchors(data: bytes, length: int, zone: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors with the first and last start of the windows of each, piece by piece."""
    left = (length - zone) // 2
    for begin in range(0, len(data) - length + 1, PIECE):
        part = data[begin : begin + PIECE + length - 1]
        n = len(part) - length + 1
        grams = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))[left : left + n + zone - 1]
        h = grams * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h &= np.uint64(~((1 << POSITION_BITS) - 1) & (1 << 64) - 1)
        h |= np.arange(len(h), dtype=np.uint64)  # the first of equal hashes wins
        least = _sliding_min(h, zone)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        anchor = (least[first] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64) + left
        yield anchor + begin, first + begin, last + begin


#: A run's windows start `back` bytes before its anchor and `width` more; 16 bits each make its reach.
RUNS = "core long, run long, k1 long, k2 int, anchor int, reach int"
BUCKETS = "core long, bucket int, digit long, rest binary, k1 long, k2 int, base int, low int, high int, own boolean"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


RUN_SCHEMA = pa.schema([("core", pa.int64()), ("run", pa.int64()), ("k1", pa.int64()), ("k2", pa.int32()), ("anchor", pa.int32()), ("reach", pa.int32())])
BUCKET_SCHEMA = pa.schema(
    [("core", pa.int64()), ("bucket", pa.int32()), ("digit", pa.int64()), ("rest", pa.binary()), ("k1", pa.int64()), ("k2", pa.int32())]
    + [("base", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("own", pa.bool_())]
)


def _runs(length: int, zone: int):
    """Rows of RUNS from k1, k2 and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        left = (length - zone) // 2
        right = length - (left + zone - 1)
        rows: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                data = (b.column(2)[i].as_py() or "").encode()
                if len(data) < length:
                    continue
                k1, k2 = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                for anchors, firsts, lasts in _anchors(data, length, zone):
                    for a, p, q in zip(anchors.tolist(), firsts.tolist(), lasts.tolist(), strict=True):
                        rows.append((_signed(digest(data[a - left : a + right])), _signed(digest(data[p : q + length])), k1, k2, a, (a - p) << 16 | q - p))
                        if len(rows) >= 10_000:
                            yield _batch(rows, RUN_SCHEMA)
                            rows = []
        if rows:
            yield _batch(rows, RUN_SCHEMA)

    return run


def _buckets(length: int, zone: int):
    """Rows of BUCKETS from k1, k2, text and the open runs of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        left, side = (length - zone) // 2, STEP - 1
        rows: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                k1, k2, data = b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py().encode()
                for r in b.column(3)[i].as_py():
                    core, a, own = r["core"], r["anchor"], r["own"]
                    p = a - (r["reach"] >> 16)
                    q = p + (r["reach"] & 0xFFFF)
                    for k in range((a - q - left) // STEP, (a - p - left) // STEP + 1):
                        base = a - left - STEP * k - side
                        low, high = max(p - base, 0), min(q - base, side)
                        start, end = base + side, base + length
                        head, tail = data[max(base, 0) : start], data[end : end + side]
                        rest = head.rjust(side, b"\0") + tail.ljust(side, b"\0")
                        rows.append((core, k, _signed(digest(data[start:end])), rest, k1, k2, base, low, high, own))
                        if len(rows) >= 5_000:
                            yield _batch(rows, BUCKET_SCHEMA)
                            rows = []
        if rows:
            yield _batch(rows, BUCKET_SCHEMA)

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, with overlapping and touching ones joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(texts: DataFrame, length: int = LENGTH, zone: int = ZONE) -> DataFrame:
    """(k1, k2, begin, end, mask): spans of bytes that repeated windows cover, by the row hashes of keyed().

    With a mask, the windows that start at `begin` plus the number of one of its bits are meant.
    Spans of one text may overlap. Each pass counts digits first (summed before the shuffle),
    then keeps the rows whose digit is not alone. Frequent digits of the first passes meet
    written tables in plain equi-joins, which adaptive execution splits; runs that are repeated
    very often are few, and meet a broadcast.
    """
    if length - zone < STEP + 8 or zone < STEP:
        raise ValueError("the zone must be within the windows")
    runs = texts.select("k1", "k2", "text").mapInArrow(_runs(length, zone), RUNS)
    # first digit: the core
    cores = written(runs.groupBy("core").count().where("count > 1").select("core"))
    runs = written(runs.join(cores, "core", "left_semi"))
    # second digit: the whole run
    firsts = [F.first(c).alias(c) for c in ("k1", "k2", "anchor", "reach")]
    kinds = written(runs.groupBy("core", "run").agg(F.count("*").alias("n"), *firsts))
    key, most = ["core", "run"], max(runs.count() // HEAVY_KINDS, HEAVY_ROWS)
    heavy = F.broadcast(kinds.where(F.col("n") > most).select(*key))
    others = kinds.where((F.col("n") > 1) & (F.col("n") <= most)).select(*key)
    settled = runs.join(heavy, key, "left_semi").unionByName(runs.join(heavy, key, "left_anti").join(others, key, "left_semi"))
    start = F.col("anchor") - F.shiftright("reach", 16)
    whole = settled.select("k1", "k2", start.alias("begin"), (start + F.col("reach").bitwiseAND(0xFFFF) + length).alias("end"), F.lit(None).cast("int").alias("mask"))
    # written, so that the join is one of two plain tables, which adaptive execution splits
    mixed = written(kinds.groupBy("core").count().where("count > 1").select("core"))
    open_runs = kinds.join(mixed, "core", "left_semi").select("k1", "k2", F.struct("core", "anchor", "reach", (F.col("n") == 1).alias("own")).alias("r"))
    by_text = open_runs.groupBy("k1", "k2").agg(F.collect_list("r").alias("runs"))
    # third digit: what the windows of a bucket have in common; all columns of the texts are named, so that one shuffle of them serves twice
    buckets = texts.join(by_text, ["k1", "k2"]).select("k1", "k2", "text", "runs", "doc_id").mapInArrow(_buckets(length, zone), BUCKETS)
    digit = ["core", "bucket", "digit"]
    shared = buckets.groupBy(*digit).count().where("count > 1").select(*digit)
    left = buckets.join(shared, digit, "left_semi")
    # last digit: the bytes of the window that the third did not hold
    each = left.withColumn("at", F.explode(F.sequence("low", "high"))).withColumn("rest", F.expr(f"substring(rest, at + 1, {STEP - 1})"))
    # all digits as two hashes, which take half the room
    window = [F.xxhash64(*digit, "at", "rest").alias("w1"), F.xxhash64("rest", "at", *digit).alias("w2")]
    windows = each.select(*window, "k1", "k2", "base", "at", "own")
    last = ["w1", "w2"]
    twice = windows.groupBy(*last).count().where("count > 1").select(*last)
    equal = windows.where("own").join(twice, last, "left_semi")
    parts = equal.groupBy("k1", "k2", "base").agg(F.bit_or(F.expr("shiftleft(1, at)")).alias("mask"))
    return whole.unionByName(parts.select("k1", "k2", F.col("base").alias("begin"), F.lit(None).cast("int").alias("end"), "mask"))


def span_sets(spans: DataFrame) -> DataFrame:
    """(k1, k2, spans): each span once, although every copy of a row brings those that all of them share."""
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end", "mask")).alias("spans"))


def keyed(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, k1, k2), the last two being row hashes; equal rows share them, and their spans."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("k1"), F.hash("doc_id").alias("k2"))


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
CUT_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.string()]


def spread(span: dict, length: int) -> list[tuple[int, int]]:
    """A row of repeated_spans() as spans."""
    if span["mask"] is None:
        return [(span["begin"], span["end"])]
    return [(a := span["begin"] + i, a + length) for i in range(STEP) if span["mask"] >> i & 1]


def _cut(length: int, with_text: bool):
    """Applies spans: from doc_id, text and spans to the columns of CUT, and the kept bytes if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                rows = []
                for text, found in zip(*(part.column(i).to_pylist() for i in (1, 2)), strict=True):
                    data = (text or "").encode()
                    spans = merged([x for s in found or [] for x in spread(s, length)])
                    edges = [0, *(x for span in spans for x in span), len(data)]
                    kept = b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)) if spans else data
                    row = (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                    rows.append((*row, kept) if with_text else row)
                types = [*CUT_ARROW, pa.binary()] if with_text else CUT_ARROW
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                names = [*(f.split()[0] for f in CUT.split(", ")), *(["kept"] if with_text else [])]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", *names])

    return run


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, zone: int = ZONE, with_text: bool = False) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if `with_text`.

    A byte goes if a string of `length` bytes that covers it starts anywhere else too, in the
    same text or another; repeated rows count as other texts. Null texts are empty; texts under
    `length` bytes stay whole. Other columns are not read. Windows are equal where their digits
    are, by two 64-bit hashes in each pass.
    """
    texts = keyed(df, text, doc_id)
    spans = repeated_spans(texts, length, zone)
    joined = texts.join(span_sets(spans), ["k1", "k2"], "left").select("doc_id", "text", "spans", "k1", "k2")
    kind = df.schema[doc_id].dataType.simpleString()
    return joined.mapInArrow(_cut(length, with_text), f"doc_id {kind}, {CUT}" + (", kept binary" if with_text else ""))


def op5_repeats(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and text: the remaining bytes, where those of a cut character become U+FFFD."""
    out = remove_repeats(load(spark, sf_dir, "documents"), with_text=True)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
