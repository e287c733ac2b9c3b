"""Document fingerprints: one-permutation MinHash with DataFrame functions only.

Each shingle is hashed once. The first bits of a hash name its bin, and a bin keeps its smallest
hash. An empty bin takes the value of another one, which it draws by hashes of its own number
until one has a value (optimal densification); a bin's digit is then the low bits of its value
hashed with the bin's number, so that bins which share a value still agree by chance alone only
once in 2^BITS. Digits are packed into longs. The share of equal digits, corrected for chance, estimates
the Jaccard similarity of the shingles.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import load

#: Words of a shingle, bins (a power of two, up to 256) and bits of a digit (whole hex digits: 4, 8 or 16).
WORDS, BINS, BITS = 5, 128, 4
#: Other bins that an empty bin draws before it takes the first in its order of all that have a value.
ATTEMPTS = 8
#: White space that parts words.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of the text's shingles, in their order, repeats included; of the whole sequence where it has fewer words, or none."""
    each = F.transform(F.split(F.btrim(text, F.lit(SPACE)), r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))

    def hashes(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - words)
        return F.when(F.size(h) < words, F.array(F.xxhash64(h))).otherwise(F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)])))

    return bind(each, hashes)


def bind(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bin_of(h: Column, bins: int = BINS) -> Column:
    """The number in the first bits of a hash."""
    return F.shiftrightunsigned(h, 64 - (bins.bit_length() - 1)).cast("int")


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """The smallest hash of each bin that has one, in the bins' order."""
    low = 64 - (bins.bit_length() - 1)
    # the first bits are the bin, so in the sorted hashes a bin's smallest is the first that differs from the one before in them
    return bind(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda h, i: F.coalesce(F.shiftrightunsigned(h.bitwiseXOR(F.get(s, i - 1)), low) != 0, F.lit(True))),
    )


def digits(minima: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The digit of each bin, empty bins densified."""
    every, low = F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(2**bits - 1).cast("long")

    def of_minima(m: Column) -> Column:
        def of_places(at: Column) -> Column:
            def of_bins(d: Column) -> Column:
                def value(b: Column) -> Column:
                    tried = [F.get(d, F.xxhash64(b, F.lit(k)).bitwiseAND(F.lit(bins - 1)).cast("int")) for k in range(ATTEMPTS)]
                    orders = F.transform(at, lambda j, k: F.xxhash64(b, j).bitwiseAND(F.lit(-256)).bitwiseOR(k.cast("long")))
                    rest = F.get(m, F.array_min(orders).bitwiseAND(F.lit(255)).cast("int"))
                    return F.coalesce(F.get(d, b), *tried, rest)  # stops at the first with a value

                return F.transform(every, lambda b: F.xxhash64(value(b), b).bitwiseAND(low))

            return bind(F.transform(every, lambda b: F.get(m, F.array_position(at, b).cast("int") - 1)), of_bins)

        return bind(F.transform(m, lambda h: bin_of(h, bins)), of_places)

    return bind(minima, of_minima)


def packed(values: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The digits in longs, the first in the highest bits."""
    per = 64 // bits

    def word(k: Column) -> Column:
        return F.aggregate(F.slice(values, k * per + 1, F.lit(per)), F.lit(0).cast("long"), lambda s, d: F.shiftleft(s, bits).bitwiseOR(d))

    return F.transform(F.sequence(F.lit(0), F.lit(bins // per - 1)), word)


def fingerprint(text: Column, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> Column:
    """The packed digits of a text (array<bigint>)."""
    return bind(digits(bin_minima(shingle_hashes(text, words), bins), bins, bits), lambda d: packed(d, bins, bits))


def as_hex(print_: Column) -> Column:
    """A fingerprint as lowercase hex, 16 digits a long."""
    return F.lower(F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimate of the Jaccard similarity: the share of equal digits without that of chance, from 0 to 1."""
    ones = sum(1 << bits * k for k in range(64 // bits))
    ones -= (1 << 64) if ones >> 63 else 0

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        shift = 1
        while shift < bits:  # a digit's lowest bit is set if any of its bits is
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
            shift *= 2
        return F.bit_count(z.bitwiseAND(F.lit(ones).cast("long")))

    wrong = sum((unequal(F.get(a, F.lit(k)), F.get(b, F.lit(k))) for k in range(bins * bits // 64)), F.lit(0))
    chance = 2.0**-bits
    return F.greatest(F.lit(0.0), ((1 - wrong / bins) - chance) / (1 - chance))


def fingerprints(df: DataFrame, text: str = "text", words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """`df` with a column fingerprint (array<bigint>) in place of any of that name; a null text is an empty one."""
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() != "fingerprint"]
    return df.select(*kept, fingerprint(F.coalesce(df[f"`{text}`"], F.lit("")), words, bins, bits).alias("fingerprint"))


def _starts(rows: DataFrame, ranges: int) -> list[tuple]:
    """The first (doc_id, hash) of each of so many ranges of rows at most."""
    dealt = rows.select("doc_id", "h").repartitionByRange(ranges, F.asc_nulls_first("doc_id"), "h")
    first = dealt.groupBy(F.spark_partition_id()).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id", "h")).alias("s"))
    return sorted(((r.s.there, r.s.doc_id or 0, r.s.h) for r in first.collect()))


def with_next(df: DataFrame, doc_id: str, carried: list[str], by: str, ranges: int | None = None) -> DataFrame:
    """(doc_id, carried columns, next_ carried columns): each row beside the next one by doc_id, the last beside the first.

    doc_id is a whole number; nulls come first, and rows of one doc_id are ordered by the long column
    `by`. Rows are dealt to ranges of the order by their bounds, which a first pass over (doc_id,
    by) finds, so the columns are shuffled once; the first row of a range goes to the one before
    it too, so no range needs another. What reaches the driver is a row for each range. Rows equal
    in both are of one range; whichever comes first is next to the other.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{by}`").alias("h"), *[F.col(f"`{c}`").alias(f"own_{c}") for c in carried])
    starts = _starts(rows, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = F.from_json(F.lit(json.dumps([{"there": t, "doc_id": d, "h": h} for t, d, h in starts])), "array<struct<there: boolean, doc_id: bigint, h: bigint>>")
    key = F.struct(F.col("doc_id").isNotNull().alias("there"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("h").alias("h"))
    steps = F.from_json(F.lit(json.dumps([1 << k for k in reversed(range(max(len(starts), 1).bit_length()))])), "array<int>")
    # the number of the last bound that is not above the key, by bisection
    number = bind(key, lambda x: F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.coalesce(F.get(bounds, at + step) <= x, F.lit(False)), at + step).otherwise(at)))
    placed = rows.select("*", number.alias("range"), key.alias("key"))
    own = F.struct(F.col("range"), F.lit(True).alias("own"))
    before = F.struct(F.when(F.col("range") > 0, F.col("range") - 1).otherwise(len(starts) - 1).alias("range"), F.lit(False).alias("own"))
    spread = placed.select("*", F.explode(F.when(F.get(bounds, F.col("range")) == F.col("key"), F.array(own, before)).otherwise(F.array(own))).alias("to"))
    dealt = spread.select("doc_id", "h", *[f"own_{c}" for c in carried], F.col("to.range").alias("range"), F.col("to.own").alias("own"))
    # a borrowed row comes last, also where the one range borrows its own first row
    order = Window.partitionBy("range").orderBy(F.desc("own"), F.asc_nulls_first("doc_id"), "h")
    following = [F.lead(f"own_{c}").over(order).alias(f"next_{c}") for c in carried]
    return dealt.select("doc_id", *[F.col(f"own_{c}").alias(c) for c in carried], "own", *following).where("own").drop("own")


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """For each row: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last quarter (floored, in code points) replaced by as many code points
    of the next document's beginning, or all it has; see with_next(). A null text is empty;
    texts without words share a fingerprint, which no other text is likely to have; a text of
    fewer than `words` words is one shingle; the only row of a table is its own next one. Other
    columns are not read. Fingerprints are arrays of longs.
    """
    own = df.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = own.select("_id", "text", F.xxhash64("text").alias("_h"), fingerprint(F.col("text"), words, bins, bits).alias("fingerprint"))
    linked = with_next(rows, "_id", ["text", "fingerprint"], "_h")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    made = linked.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited_text"))
    both = made.select("*", fingerprint(F.col("edited_text"), words, bins, bits).alias("edited_fingerprint"))
    return both.select(
        F.col("doc_id").cast(df.schema[doc_id].dataType),
        "n_chars",
        "edited_text",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bins, bits).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), bins, bits).alias("near_next"),
    )


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    out = edited_fingerprints(load(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
