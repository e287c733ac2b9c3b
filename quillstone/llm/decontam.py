"""Benchmark decontamination: approximate matches of test items inside documents.

An item may match with up to k edits. It is split into k + 1 pieces; k edits leave one piece
unhurt, so every match holds an exact piece hit at the place that the piece's offset says, give
or take k. Places with a hit are verified by Myers' bit-parallel edit distance.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, text_udf

#: Edits allowed for each character of an item.
EDIT_RATE = 0.06
#: Items are matched in blocks of at most so many characters; a block is what is broadcast.
BLOCK_CHARS = 4_000_000
#: Items under this length (normalised) say nothing inside a text: they match a text only as a whole.
LEAST_CHARS = 20


def normalised(text: str) -> str:
    """Lower case, with runs of white space as one space."""
    return " ".join(text.lower().split())


def budget(item: str, rate: float) -> int:
    return int(len(item) * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of about equal length, with their offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to a substring of the text, and where that ends first (Myers 1999)."""
    m = len(pattern)
    eq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        eq[c] |= 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = every, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        x = eq.get(c, 0)
        xv = x | mv
        xh = (((x & pv) + pv) ^ pv) | x
        ph = mv | ~(xh | pv) & every
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & every, mh << 1 & every
        pv = mh | ~(xv | ph) & every
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def matcher(items: list[tuple[int, str]], rate: float, least: int = LEAST_CHARS) -> Callable[[str], list[tuple[int, int, int]]]:
    """A function from a text to (item number, distance, end in the normalised text), the best match of each item.

    Items under `least` characters match texts that are equal to them.
    """
    import ahocorasick

    finder = ahocorasick.Automaton()
    budgets = [budget(t, rate) for _, t in items]
    held: dict[str, list[tuple[int, int]]] = defaultdict(list)
    short: dict[str, list[int]] = defaultdict(list)
    for n, ((_, t), k) in enumerate(zip(items, budgets, strict=True)):
        if len(t) < least:
            short[t].append(n)
            continue
        for offset, piece in pieces(t, k):
            held[piece].append((n, offset))
    for piece, places in held.items():
        finder.add_word(piece, (len(piece), places))
    finder.make_automaton()
    verified: dict[tuple[int, str], tuple[int, int]] = {}

    def match(text: str) -> list[tuple[int, int, int]]:
        line = normalised(text)
        starts: dict[int, list[int]] = defaultdict(list)
        for end, (size, places) in finder.iter(line) if held else ():
            for n, offset in places:
                starts[n].append(end + 1 - size - offset)
        found = [(n, 0, len(line)) for n in short.get(line, ())] if line else []
        for n, at in starts.items():
            item, k = items[n][1], budgets[n]
            best = (k + 1, 0)
            at.sort()
            i = 0
            while i < len(at):
                j = i
                while j + 1 < len(at) and at[j + 1] - at[j] <= 2 * k:  # one window for hits on near diagonals
                    j += 1
                begin = max(0, at[i] - k)
                window = line[begin : at[j] + len(item) + k]
                key = (n, window)
                if key not in verified:
                    if len(verified) >= 20_000:
                        verified.clear()
                    verified[key] = best_match(item, window)
                distance, end = verified[key]
                if distance < best[0]:
                    best = (distance, begin + end)
                i = j + 1
            if best[0] <= k:
                found.append((n, *best))
        return sorted(found)

    return match


def item_blocks(items: DataFrame, item_id: str, text: str, chars: int) -> Iterator[list[tuple[object, str]]]:
    """Normalised items in blocks of at most `chars` characters (or one longer item); the driver holds one block."""
    block: list[tuple[object, str]] = []
    size = 0
    for i, t in items.select(item_id, text).where(F.col(text).isNotNull()).distinct().orderBy(item_id, text).toLocalIterator():
        t = normalised(t)
        if not t:
            continue
        if block and size + len(t) > chars:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block:
        yield block


def find_contamination(
    docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS, least: int = LEAST_CHARS
) -> DataFrame:
    """(doc_id, item_id, distance, end) for each document and item within `rate` edits a character.

    Distances and ends are of normalised texts (lower case, single spaces); the best match of each
    pair is given, the first end on ties. Null and empty texts match nothing, and null and empty
    items are not looked for; items under `least` characters match texts that consist of them, so
    that a short answer does not mark every text that mentions it. Repeated rows give repeated results. Items
    are matched in blocks, each with its own pass over the documents; nothing is shuffled.
    """
    kinds = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, distance int, end int"
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text is not null")

    def one(block: list[tuple[object, str]]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            match = matcher(sent.value, rate, least)
            for b in batches:
                ids, found = b.column(0), ([], [], [], [])
                for i in range(b.num_rows):
                    for n, distance, end in match(b.column(1)[i].as_py()):
                        for column, value in zip(found, (i, sent.value[n][0], distance, end), strict=True):
                            column.append(value)
                if found[0]:
                    taken = ids.take(pa.array(found[0], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [taken, pa.array(found[1]), pa.array(found[2], pa.int32()), pa.array(found[3], pa.int32())], names=["doc_id", "item_id", "distance", "end"]
                    )

        return rows.mapInArrow(run, schema)

    empty = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, (one(b) for b in item_blocks(items, item_id, text, block_chars)), empty)


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS, least: int = LEAST_CHARS) -> DataFrame:
    """The rows of `docs` in which no item is found, as find_contamination() finds them; null texts stay. No shuffle."""
    for block in item_blocks(items, item_id, text, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def make(sent=sent):
            match = matcher(sent.value, rate, least)
            return lambda t: (bool(match(t)),)

        docs = docs.where(~text_udf("hit boolean", make)(F.col(f"`{text}`")).getField("hit"))
    return docs


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
