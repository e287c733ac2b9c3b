"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of 32 segments of two bits. The Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints, so pairs
within the radius lie within it on the grid too. The segments form eight groups; of two vectors
within a distance of 4, at least four groups are equal, so the range join becomes an equi-join
on the cells of every choice of four groups. Candidates of a cell are compared by their
embeddings, then exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import load, text_udf, use_checkpoints

RADIUS, SHINGLE = 4, 4
#: Groups of four two-bit segments each.
GROUPS = 8
#: Fingerprints of a cell that one task compares; larger cells are dealt out in pairs of blocks.
BLOCK = 2048
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: A-Z only, and blanks as in ASCII
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        hashes = [xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = [0, *(ends[: n - shingle] + 1).tolist()]
        hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the numbers, as a signed number."""
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    packed = np.packbits(2 * bits > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`df` with fp, a signed 64-bit number (zero for null and empty texts)."""
    made = text_udf("fp long", lambda: lambda t: (fingerprint(t, shingle),))(F.col(text))
    return df.withColumn("_fp", made).withColumn("fp", F.col("_fp.fp")).drop("_fp")


def segment_counts(x: np.ndarray) -> np.ndarray:
    """Two-bit fields with the bit counts of the 32 segments."""
    x = x.astype(np.uint64)
    return x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))


def embedding_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of two arrays of segment counts (0, 1 or 2 in each two-bit field)."""
    low = np.uint64(0x5555555555555555)
    d = a ^ b
    # of the pairs (0,1), (1,2) and (0,2), the differences are 1, 1 and 2, the exclusive ors 01, 11 and 10
    return np.bitwise_count(d & low).astype(np.int64) + 2 * np.bitwise_count((d >> np.uint64(1)) & ~d & low)


def compare(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within the radius: by the embedding first, then exactly."""
    near = embedding_distance(segment_counts(a)[:, None], segment_counts(b)[None, :]) <= radius
    i, j = np.nonzero(near)
    exact = np.bitwise_count(a[i] ^ b[j]) <= radius
    return i[exact], j[exact]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def forest_edges(a: np.ndarray, la: np.ndarray, b: np.ndarray | None, lb: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Label pairs that join what the links of a cell, or of two of its blocks, connect; none within a label."""
    if b is None and len(a) == 2:
        near = la[0] != la[1] and embedding_distance(*segment_counts(a)) <= radius and np.bitwise_count(a[0] ^ a[1]) <= radius
        return [(int(la[0]), int(la[1]))] if near else []
    x, labels = (a, la) if b is None else (np.concatenate([a, b]), np.concatenate([la, lb]))
    named, at = np.unique(labels, return_inverse=True)
    if len(named) == 1:
        return []
    forest, edges, shift, right = Forest(len(named)), [], 0 if b is None else len(a), x if b is None else b
    for s in range(0, len(a), 256):
        i, j = compare(a[s : s + 256], right, radius)
        u, v = at[i + s], at[j + shift]
        fresh = u != v
        if fresh.any():
            for p, q in np.unique(np.sort(np.stack([u[fresh], v[fresh]], 1), axis=1), axis=0).tolist():
                if forest.join(p, q):
                    edges.append((int(named[p]), int(named[q])))
    return edges


WORK = "la binary, a binary, lb binary, b binary, u long, v long"


def _cell_edges(radius: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Edges of the small cells of a partition sorted by cell; pairs of blocks of the large ones."""
    schema = pa.schema([("la", pa.binary()), ("a", pa.binary()), ("lb", pa.binary()), ("b", pa.binary()), ("u", pa.int64()), ("v", pa.int64())])

    def cell(fp: np.ndarray, label: np.ndarray) -> Iterator[tuple]:
        if len(fp) <= block:
            yield from ((None, None, None, None, u, v) for u, v in forest_edges(fp, label, None, None, radius))
            return
        if (label == label[0]).all():
            return
        parts = [(label[i : i + block].tobytes(), fp[i : i + block].tobytes()) for i in range(0, len(fp), block)]
        for i, p in enumerate(parts):
            for q in parts[i:]:
                yield (*p, *q, None, None)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last cell may go on in the next batch
        rows: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            combo, key, fp, label = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.view(np.uint64)
            if held is not None:
                combo, key, fp, label = (np.concatenate(x) for x in zip(held, (combo, key, fp, label), strict=True))
            cuts = np.flatnonzero((combo[1:] != combo[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
            mixed = np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts)
            for k in np.flatnonzero(mixed[:-1]).tolist():
                rows.extend(cell(fp[starts[k] : ends[k]], label[starts[k] : ends[k]]))
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
            held = (combo[starts[-1] :], key[starts[-1] :], fp[starts[-1] :], label[starts[-1] :])
        if held is not None and len(held[2]) > 1:
            for row in cell(held[2], held[3]):
                rows.append(row)
                if len(rows) >= 100:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    return run


def _block_edges(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges: list[tuple[int, int]] = []
            for la, a, lb, c in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                edges += forest_edges(np.frombuffer(a, np.uint64), np.frombuffer(la, np.int64), np.frombuffer(c, np.uint64), np.frombuffer(lb, np.int64), radius)
            if edges:
                u, v = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def cell_columns(choices: Sequence[Sequence[int]]):
    """An array of (choice, key): the key is what the chosen groups' segment counts make."""
    low, high = F.lit(0x5555555555555555), F.shiftrightunsigned("fp", 1)
    ones, twos = F.col("fp").bitwiseXOR(high).bitwiseAND(low), F.col("fp").bitwiseAND(high).bitwiseAND(low)
    counts = ones.bitwiseOR(F.shiftleft(twos, 1))

    def mask(groups: Sequence[int]) -> int:
        m = sum(0xFF << 8 * g for g in groups)
        return m - (1 << 64) if m >> 63 else m

    return F.array(*[F.struct(F.lit(i).cast("short").alias("choice"), counts.bitwiseAND(F.lit(mask(g)).cast("long")).alias("key")) for i, g in enumerate(choices)])


def links(points: DataFrame, choices: Sequence[Sequence[int]], radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) between labels of the distinct fingerprints `points` (fp, label).

    They connect whatever the links of pairs connect that share a cell of one of the choices.
    Cells are read in sorted order, one at a time; a cell over `block` rows becomes pairs of
    blocks, which are dealt out anew, so no task holds more than that.
    """
    # a table of distinct fingerprints is small, and each gives many rows: they are dealt to as many tasks as a shuffle has
    dealt_out = points.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    spread = dealt_out.withColumn("_cell", F.explode(cell_columns(choices))).select(F.col("_cell.choice").alias("choice"), F.col("_cell.key").alias("key"), "fp", "label")
    sorted_cells = spread.repartition("choice", "key").sortWithinPartitions("choice", "key")
    work = sorted_cells.mapInArrow(_cell_edges(radius, block), WORK).checkpoint()
    dealt = work.where("a is not null").select("la", "a", "lb", "b").repartition(F.rand(SEED))
    return work.where("u is not null").select("u", "v").unionByName(dealt.mapInArrow(_block_edges(radius), "u long, v long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node reachable.

    Each round links neighbours to the smallest node in reach (large star, then small star)
    and is written to the checkpoint folder; rounds grow with the logarithm of the longest path.
    """
    use_checkpoints(edges.sparkSession)
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before: tuple | None = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(lowest.select("u", F.col("m").alias("v")))
        edges = small.distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def near_duplicate_classes(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(fp, root) for each distinct fingerprint of `prints` (fp): the smallest fingerprint linked to it, directly or not."""
    if radius >= GROUPS:
        raise ValueError(f"the radius must be under {GROUPS}")
    use_checkpoints(prints.sparkSession)
    points = prints.select("fp").distinct().withColumn("label", F.col("fp")).checkpoint()
    choices = list(combinations(range(GROUPS), GROUPS - radius))
    # two disjoint choices join most of a dense neighbourhood; the others then look for links across classes only
    first = [c for c in choices if c in (tuple(range(GROUPS - radius)), tuple(range(radius, GROUPS)))]
    for part in (first, [c for c in choices if c not in first]):
        if part:
            roots = components(links(points, part, radius, block))
            joined = points.join(roots, points["label"] == roots["node"], "left")
            points = joined.select("fp", F.coalesce("root", "label").alias("label")).checkpoint()
    return points.withColumnRenamed("label", "root")


def _prints(df: DataFrame, text: str, doc_id: str, shingle: int) -> DataFrame:
    """(doc_id, key, fp) for each row; key is its row_key()."""
    use_checkpoints(df.sparkSession)
    texts = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    return with_fingerprints(texts, "_text", shingle).select("doc_id", row_key(F.col("_text")).alias("key"), "fp").checkpoint()


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for each row: component_id is the smallest doc_id linked to it, itself included.

    Fingerprints within `radius` differing bits link. Null and empty texts have the fingerprint
    0, which links like any other. Repeated rows stay. A row without a doc_id takes part; a class
    without any doc_id has a null component_id. Classes are named by distinct fingerprints; rows
    meet their fingerprint's name last, in a join of two written tables that can be split.
    """
    rows = _prints(df, text, doc_id, shingle)
    classes = near_duplicate_classes(rows, radius)
    # written, so that the join by root is one of two plain tables, which can be split where a class is large
    named = rows.groupBy("fp").agg(F.min("doc_id").alias("_m")).join(classes, "fp").groupBy("root").agg(F.min("_m").alias("component_id")).checkpoint()
    names = classes.join(named, "root").select("fp", "component_id").checkpoint()
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def row_key(text: Column) -> Column:
    """What tells a row of one doc_id from others: two hashes of its text, 96 bits in all."""
    return F.struct(F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"))


def first_rows(df: DataFrame, firsts: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows of `df` that `firsts` (_id, _key) names by doc_id and row_key(), one for each; of repeated rows one."""
    rows = df.select(F.struct("*").alias("_row"), F.col(f"`{doc_id}`").alias("_own"), row_key(F.col(f"`{text}`")).alias("_k"))
    named = rows.join(firsts, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left_semi")
    each = Window.partitionBy("_own", "_k").orderBy("_k")
    return named.withColumn("_n", F.row_number().over(each)).where("_n = 1").select("_row.*")


def one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `df` without near-duplicates: one row of each class stays, with all its columns.

    It is the row of the smallest doc_id, rows without one last; the smallest hash of the text
    decides between rows of one doc_id. Of repeated rows one stays.
    """
    rows = _prints(df, text, doc_id, shingle)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    by_print = rows.groupBy("fp").agg(F.min(first).alias("_first")).join(near_duplicate_classes(rows, radius), "fp")
    firsts = by_print.groupBy("root").agg(F.min("_first").alias("_first")).select(F.col("_first.doc_id").alias("_id"), F.col("_first.key").alias("_key")).checkpoint()
    return first_rows(df, firsts, text, doc_id)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


