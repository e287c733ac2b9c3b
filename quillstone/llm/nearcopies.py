"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash through the segment-popcount embedding of operator 9, for distances that 64 bits cannot
hold: pairs of a similarity of 0.8 differ in up to a sixth of their bits (FLIP), 5 to 25 of 64,
and a grid over 64 bits takes a radius under 8. So fingerprints have 2,048 bits, the first 64 of
which are operator 9's, of five-word shingles. They are embedded as the bit counts of 1,024
segments of two bits. Candidates share a cell of this grid: the counts of a few segments, in one
of so many choices of them that a pair of the similarity shares none with a chance of CHANCE at
most. A cell's rows hold whole fingerprints, so a cell gives only a forest of the pairs within a
radius that a pair of the similarity exceeds with that chance; forests make clusters, in whose
blocks all pairs are held against the similarity itself. So neither step gives a row for each
pair of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import text_udf, written
from quillstone.llm.simhash import SEED, Forest, components, first_rows, row_key, segment_counts

SHINGLE, SIMILARITY = 5, 0.8
#: Words of a fingerprint, and segments.
WORDS = 32
SEGMENTS = 32 * WORDS
#: The chance that a pair of the similarity shares no cell, or exceeds a radius.
CHANCE = 1e-8
#: The chance that a bit differs between sets of the similarity is at most the second; between sets of FEW shingles or less, at most the first.
FEW, FLIP_FEW, FLIP = 5, 0.1875, 0.162
#: A choice has so many segments that a fingerprint meets about this many others in a cell.
CELL = 2000
#: Choices of the first round, after which only links between different clusters are looked for.
FIRST = 2
#: So many choices are read at a time, or more as long as they give no more rows than that: this bounds the shuffle files.
ROUND, ROUND_ROWS = 4, 500_000
#: Fingerprints of a cell that one task compares (9 MB); larger cells are dealt out in pairs of blocks, which unrelated texts do not reach: their largest cell has one in 2 ** segments.
BLOCK = 1 << 15
#: Sets of a cluster, and their shingles, in a block; shingles that are counted at a time.
SETS, SHINGLES, COLUMNS = 256, 500_000, 2048
#: The names of so many candidate sets are broadcast to fetch their texts (some 10 MB); more meet them in a shuffle.
MAX_BROADCAST = 200_000


def shingles(text: str) -> set[bytes]:
    """The distinct shingles; a shorter text is one shingle, an empty one has none."""
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The words of a set's fingerprint: bits set in over half of the hashes, and of what is mixed from them for the further words."""
    bits = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(hashes), 255):  # sums that fit a byte
        x = hashes[i : i + 255, None] + np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
        x[:, 0] = hashes[i : i + 255]
        bits += np.add.reduce(np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")


def hashed(text: str) -> np.ndarray:
    """The set of shingles as sorted hashes."""
    from xxhash import xxh64_intdigest

    return np.unique(np.fromiter((xxh64_intdigest(s, SEED) for s in shingles(text)), np.uint64))


def described(text: str) -> tuple[int, int, bytes]:
    """A hash of the set of shingles, the set's size and its fingerprint."""
    from xxhash import xxh64_intdigest

    hashes = hashed(text)
    signed = np.array([xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED)], np.uint64).view(np.int64)
    return int(signed[0]), len(hashes), fingerprint(hashes).tobytes()


@lru_cache
def radius(bits: int, flip: float) -> int:
    """The differing bits that a pair exceeds with a chance of CHANCE at most."""
    term, total, k = (1 - flip) ** bits, 0.0, 0
    while total + term < 1 - CHANCE:
        total += term
        term *= (bits - k) / (k + 1) * flip / (1 - flip)
        k += 1
    return k


@lru_cache
def n_choices(segments: int, flip: float) -> int:
    """Choices of so many segments, one of which at least a pair shares but for CHANCE.

    A segment's counts are equal with a chance of (1 - flip) ** 2 or more; the number of equal
    segments of a pair is binomial, and a choice is shared if all of its segments are among them.
    """
    same = (1 - flip) ** 2
    equal = np.arange(SEGMENTS + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, SEGMENTS + 1)))])
    weight = np.exp(logs[-1] - logs - logs[::-1] + equal * np.log(same) + (SEGMENTS - equal) * np.log(1 - same))
    shared = np.array([comb(e, segments) / comb(SEGMENTS, segments) for e in equal.tolist()])
    n = 1
    while (weight * (1 - shared) ** n).sum() > CHANCE:
        n += max(1, n // 50)
    return n


def segments_for(points: int) -> int:
    """The segments of a choice: two fingerprints agree in one with a chance of 3/8."""
    return max(2, int(np.ceil(np.log(max(points, 1) / CELL) / np.log(8 / 3))))


def choices_of(segments: int) -> np.ndarray:
    """The segments of each choice; every segment is taken once before any is taken again."""
    n, draw = n_choices(segments, FLIP_FEW), np.random.default_rng(SEED)
    turns = [draw.permutation(SEGMENTS) for _ in range(n * segments // SEGMENTS + 1)]
    return np.concatenate(turns)[: n * segments].reshape(n, segments)


CELLS = "key long, label long, n long, words binary"


def _cells(choices: np.ndarray, start: int, common: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of CELLS from label, n and words, for the choices that are numbered from `start` on; those from `common` on for small sets only."""

    def rows_of(words: np.ndarray, columns: list[np.ndarray], mine: np.ndarray, first: int) -> pa.RecordBatch:
        fields = segment_counts(words).astype("<u8").view(np.uint8)
        counts = np.stack([fields >> s & 3 for s in (0, 2, 4, 6)], 2).reshape(len(words), SEGMENTS)
        key = np.zeros((len(words), len(mine)), np.int64)
        for j in range(mine.shape[1]):
            key = 3 * key + counts[:, mine[:, j]]
        key += np.arange(first, first + len(mine)) << 48
        ends = np.arange(key.size + 1, dtype=np.int32) * (8 * WORDS)
        held = pa.Array.from_buffers(pa.binary(), key.size, [None, pa.py_buffer(ends), pa.py_buffer(np.repeat(words, len(mine), 0))])
        flat = [pa.array(c) for c in (key.ravel(), *(np.repeat(c, len(mine)) for c in columns))]
        return pa.RecordBatch.from_arrays([*flat, held], names=["key", "label", "n", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                columns = [part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2)]
                words = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u8").reshape(-1, WORDS)
                split = min(max(common - start, 0), len(choices))
                if split:
                    yield rows_of(words, columns, choices[:split], start)
                few = columns[1] <= FEW
                if split < len(choices) and few.any():
                    yield rows_of(words[few], [c[few] for c in columns], choices[split:], start + split)

    return run


#: A row of a cell.
SET = np.dtype([("label", "<i8"), ("n", "<i8"), ("words", "<u8", WORDS)])


def candidates(a: np.ndarray, b: np.ndarray | None) -> list[tuple[int, int]]:
    """A forest, as pairs of labels, of the pairs of a cell, or of two of its blocks, that may be similar."""
    right = a if b is None else b
    labels = np.unique(np.concatenate([a["label"], right["label"]]))
    if len(labels) == 1:
        return []
    first = radius(128, FLIP_FEW if min(a["n"].min(), right["n"].min()) <= FEW else FLIP)
    forest = Forest(len(labels))
    found: list[tuple[int, int]] = []
    step = max(1, (1 << 17) // len(right))
    head, n = np.ascontiguousarray(right["words"][:, :2].T), right["n"]
    for s in range(0, len(a), step):
        x, y = a[s : s + step], s if b is None else 0
        near = np.bitwise_count(x["words"][:, :1] ^ head[0, y:])
        near += np.bitwise_count(x["words"][:, 1:2] ^ head[1, y:])
        i, j = np.divmod(np.flatnonzero(near <= first), near.shape[1])
        j += y
        fits = x["label"][i] != right["label"][j]
        if b is None:
            fits &= j > i + s
        fits &= (5 * x["n"][i] >= 4 * n[j]) & (5 * n[j] >= 4 * x["n"][i])
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        most = np.where(np.maximum(x["n"][i], n[j]) <= FEW, radius(64 * WORDS, FLIP_FEW), radius(64 * WORDS, FLIP))
        good = np.bitwise_count(x["words"][i] ^ right["words"][j]).sum(1, dtype=np.int64) <= most
        at = [np.searchsorted(labels, c).tolist() for c in (x["label"][i[good]], right["label"][j[good]])]
        found += [(int(labels[p]), int(labels[q])) for p, q in zip(*at, strict=True) if forest.join(p, q)]
    return found


def _cell_pairs(block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidates of the small cells of a partition sorted by cell; pairs of blocks of the large ones."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("u", pa.int64()), ("v", pa.int64())])

    def cell(x: np.ndarray) -> Iterator[tuple]:
        if len(x) <= block:
            yield from ((None, None, u, v) for u, v in candidates(x, None))
            return
        x = x[np.argsort(x["label"], kind="stable")]  # so that most blocks of a large cluster have one label
        parts = [x[i : i + block] for i in range(0, len(x), block)]
        for i, p in enumerate(parts):
            if p["label"][0] != p["label"][-1]:
                yield p.tobytes(), None, None, None
            for q in parts[i + 1 :]:
                if p["label"][0] != q["label"][-1]:
                    yield p.tobytes(), q.tobytes(), None, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        key, held = np.empty(0, np.int64), np.empty(0, SET)  # the last cell may go on in the next batch
        for b in batches:
            new = np.empty(b.num_rows, SET)
            for i, name in enumerate(("label", "n"), 1):
                new[name] = b.column(i).to_numpy(zero_copy_only=False)
            new["words"] = np.frombuffer(b"".join(b.column(3).to_pylist()), "<u8").reshape(-1, WORDS)
            key, held = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)]), np.concatenate([held, new])
            if not len(key):
                continue
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            mixed = np.minimum.reduceat(held["label"], starts) != np.maximum.reduceat(held["label"], starts)
            for k in np.flatnonzero(mixed[:-1]).tolist():
                yield held[starts[k] : starts[k + 1]]
            key, held = key[starts[-1] :], held[starts[-1] :]
        if len(held) and (held["label"] != held["label"][0]).any():
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for x in cells(batches):
            for row in cell(x):
                rows.append(row)
                if len(rows) >= (1000 if row[0] is None else 20):
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    return run


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for p, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if pairs := candidates(np.frombuffer(p, SET), None if q is None else np.frombuffer(q, SET)):
                u, v = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def candidate_pairs(points: DataFrame, choices: np.ndarray, start: int = 0, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (u, v) of labels of `points` (label, n, words): in each cell they join whatever its pairs join that may be similar.

    Cells are those of the choices from `start` on. Of the choices, the first ones that a pair of
    larger sets needs are taken for all sets. Some choices are read at a time, so that shuffle
    files of all of them are never held at once.
    """
    common = n_choices(choices.shape[1], FLIP)
    round_of = max(ROUND, ROUND_ROWS // max(points.count(), 1))
    found = []
    for at in range(start, len(choices), round_of):
        spread = points.select("label", "n", "words").mapInArrow(_cells(choices[at : at + round_of], at, common), CELLS)
        work = written(spread.repartition("key").sortWithinPartitions("key").mapInArrow(_cell_pairs(block), "a binary, b binary, u long, v long"))
        blocks = work.where("a is not null").select("a", "b").repartition(F.rand(SEED))
        found.append(work.where("a is null").select("u", "v").unionByName(blocks.mapInArrow(_block_pairs, "u long, v long")))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return written(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def dealt(points: DataFrame) -> DataFrame:
    """Points give many rows each, so they are dealt to as many tasks as a shuffle has."""
    return points.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def candidate_clusters(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, n, root) for each set of `points` (id, n, words): root is the smallest id that candidates link to it, directly or not."""
    choices = choices_of(segments_for(points.count()))
    labelled = points.withColumn("label", F.col("id"))
    for part, start, columns in ((choices[:FIRST], 0, ["id", "n", "words"]), (choices, FIRST, ["id", "n"])):
        roots = components(candidate_pairs(labelled, part, start, block)).withColumnRenamed("node", "label")
        labelled = written(dealt(labelled.join(roots, "label", "left").select(*columns, F.coalesce("root", "label").alias("label"))))
    return labelled.withColumnRenamed("label", "root")


def similar_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of sets that reach the similarity, in whole numbers: shared shingles are counted by products of incidence matrices."""
    sizes = np.array([len(s) for s in sets])
    inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    kept = np.flatnonzero(counts[inverse] > 1)
    column = (np.cumsum(counts > 1) - 1)[inverse[kept]]
    order = np.argsort(column, kind="stable")
    row, column = np.repeat(np.arange(len(sets)), sizes)[kept][order], column[order]
    both = np.zeros((len(sets), len(sets)))
    for s in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [s, s + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[a:b], column[a:b] - s] = 1
        both += has @ has.T
    return np.nonzero(np.triu(5 * both >= 4 * (sizes[:, None] + sizes - both), 1))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest (u, v) of the links in each group of rows (root, low, high, id, hashes), which come sorted by the first three."""
    key, ids, sets = None, [], []

    def links() -> Iterator[pa.RecordBatch]:
        if len(ids) > 1:
            forest, pairs = Forest(len(ids)), zip(*(x.tolist() for x in similar_pairs(sets)), strict=True)
            if made := [(ids[i], ids[j]) for i, j in pairs if forest.join(i, j)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made, strict=True)], names=["u", "v"])

    for b in batches:
        for *new, i, hashes in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if new != key:
                yield from links()
                key, ids, sets = new, [], []
            ids.append(i)
            sets.append(np.frombuffer(hashes, "<u8"))
    yield from links()


def verified(clusters: DataFrame, names: DataFrame, texts: DataFrame, block: int = SETS) -> DataFrame:
    """Links (u, v) of ids that join what pairs within the clusters (id, n, root) join whose shingles reach the similarity.

    `names` (id, doc_id, key) has the row of `texts` (doc_id, key, text) that stands for a set, so
    that only the texts of clusters are read on. Each two blocks of a cluster meet once.
    """
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / SHINGLES)).alias("blocks")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("c"), blocks).where("c > 1").drop("c")
    wanted = written(clusters.join(sizes, "root").join(names, "id").select("id", "root", "blocks", F.col("doc_id").alias("_doc"), F.col("key").alias("_key")))
    if wanted.count() <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    made = text_udf("hashes binary", lambda: lambda t: (hashed(t).astype("<u8").tobytes(),))(F.col("text"))
    rows = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key"))).select("id", "root", "blocks", made.alias("m"))
    held = written(rows.select("id", "root", "blocks", "m.hashes").dropDuplicates(["id"]))
    own = held.withColumn("own", F.expr("pmod(id, blocks)"))
    others = F.expr("if(blocks = 1, array(0L), filter(sequence(0L, blocks - 1), x -> x <> own))")
    met = own.withColumn("other", F.explode(others)).select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "hashes")
    group = ["root", "low", "high"]
    return written(met.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links, "u long, v long"))


def near_copy_classes(points: DataFrame, names: DataFrame, texts: DataFrame, block: int | None = None) -> DataFrame:
    """(id, root) for each set of `points` (id, n, words): the smallest id linked to it, directly or not."""
    clusters = candidate_clusters(points, block or BLOCK)
    roots = components(verified(clusters, names, texts, block or SETS)).select(F.col("node").alias("id"), "root")
    return points.select("id").join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int | None = None) -> DataFrame:
    """The rows of `df` without near copies: one row of each class stays, with all its columns.

    It is the row of the smallest doc_id, rows without one last; the smallest hash of the text
    decides between rows of one doc_id. Of repeated rows one stays. Null and empty texts are one class.
    """
    made = text_udf("id long, n int, words binary", lambda: described)(F.col("text"))
    texts = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("key", row_key(F.col("text")))
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key").alias("first")
    # equal sets are one point; the text of the first row stands for all of them
    by_set = texts.withColumn("_made", made).select("doc_id", "key", "_made.*").groupBy("id").agg(F.min(F.struct(first, "n", "words")).alias("_first"))
    points = written(dealt(by_set.select("id", "_first.n", "_first.words", F.col("_first.first").alias("first"))))
    names = points.select("id", "first.doc_id", "first.key")
    classes = near_copy_classes(points.drop("first"), names, texts, block)
    firsts = points.join(classes, "id").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    return first_rows(df, written(firsts), text, doc_id)
