"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame expressions.

A sketch is the ascending list of the k smallest distinct hashes of a text's shingles.
Sketches of parts merge into the sketch of the whole (the k smallest of both lists), and
two sketches estimate resemblance, containment and the number of distinct shingles. With
at most k shingles everything is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import whole_text

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
HASH_BITS = 48
_HEX_DIGITS = HASH_BITS // 4
ROWS_PER_BUCKET = 1_000
RANGES = 256


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: Column, width: int = SHINGLE_WORDS) -> Column:
    """48-bit hashes of all shingles; fewer words than ``width`` make one shingle, none make none."""

    def hashed(*parts: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*parts), 64 - HASH_BITS)

    count = F.size(words)
    many = F.transform(F.sequence(F.lit(0), count - width), lambda i: hashed(*(F.get(words, i + j) for j in range(width))))
    few = F.array(hashed(F.array_join(words, " "), count))
    none = F.array().cast("array<bigint>")
    return F.when(count >= width, many).when(count > 0, few).otherwise(none)


def sketch(text: Column, k: int = SKETCH_SIZE, width: int = SHINGLE_WORDS) -> Column:
    hashes = bound(words_of(text), lambda words: shingle_hashes(words, width))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of two texts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Share of common shingles among all; two empty sketches are alike (1), an empty and another are not (0)."""

    def share(both: Column) -> Column:
        shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.greatest(F.size(both), F.lit(1)))

    return bound(merge(a, b, k), share)


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    estimate = F.lit((k - 1) * float(2**HASH_BITS)) / (F.array_max(a) + 1)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(estimate)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = distinct_shingles(merge(a, b, k), k)
    shared = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def as_text(a: Column) -> Column:
    """A sketch as hexadecimal digits, twelve for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), _HEX_DIGITS, "0")), "")


def sketch_documents(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SKETCH_SIZE) -> DataFrame:
    """Per row: key, sketch, estimated distinct shingles. Null texts count as empty."""
    return df.select(key, sketch(whole_text(text), k).alias("sketch")).withColumn(
        "n_shingles", distinct_shingles(F.col("sketch"), k)
    )


def merge_parts(sketches: DataFrame, key: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    The hashes are numbered within each salted share of a key first and only k of each go
    on, so a key with any number of parts never meets in one task whole.
    """
    hashes = sketches.select(key, F.explode("sketch").alias("h"), F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("s"))
    hashes = hashes.groupBy(key, "s", "h").agg(F.lit(1).alias("one"))

    def smallest(rows: DataFrame, *by: str) -> DataFrame:
        return rows.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).filter(F.col("n") <= k)

    first = smallest(hashes, key, "s").select(key, "h").distinct()
    return smallest(first, key).groupBy(key).agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def _with_bucket(df: DataFrame, key: str) -> DataFrame:
    """Add ``bucket``, growing with the key, with about a thousand rows each.

    Range borders come from approximate quantiles (at most 255 numbers reach the driver);
    each range is cut evenly into as many buckets as its size asks for.
    """
    shares = [i / RANGES for i in range(RANGES + 1)]
    row = df.agg(F.count(key).alias("n"), F.percentile_approx(key, shares, 10_000).alias("q")).first()
    if not row["n"]:
        return df.withColumn("bucket", F.lit(0).cast("long"))
    borders = sorted(set(row["q"]))
    inner = borders[1:] or borders
    cuts = max(1, -(-row["n"] // (RANGES * ROWS_PER_BUCKET)))
    place = F.aggregate(
        F.array(*(F.lit(int(b)) for b in inner)), F.lit(0), lambda n, b: n + F.when(b <= F.col(key), 1).otherwise(0)
    )
    low = F.get(F.array(*(F.lit(int(b)) for b in borders)), F.col("_range"))
    high = F.get(F.array(*(F.lit(int(b)) for b in [*inner, min(inner[-1] + 1, 2**63 - 1)])), F.col("_range"))
    # In doubles, since ids far apart differ by more than a long; their order stays.
    width = high.cast("double") - low.cast("double")
    share = (F.col(key).cast("double") - low.cast("double")) / F.greatest(width, F.lit(1.0))
    inside = F.least(F.greatest(F.floor(share * cuts), F.lit(0)), F.lit(cuts - 1))
    placed = df.withColumn("_range", place).withColumn("bucket", F.col("_range").cast("long") * cuts + inside)
    return placed.withColumn("bucket", F.coalesce("bucket", F.lit(-1).cast("long"))).drop("_range")


def with_next(df: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """Add each document's successor by ascending doc_id (the first follows the last).

    ``df`` has doc_id and text. Rows are dealt into key-ordered buckets, the successor is
    the next row of the bucket, and the bucket's last row takes the first row of the next
    bucket with rows. Texts are shuffled once. Rows with equal ids are ordered by text.
    """
    docs = _with_bucket(df, "doc_id")
    everywhere = Window.orderBy("bucket")  # one row per bucket
    before = F.lag("bucket").over(everywhere)
    last = F.max("bucket").over(Window.partitionBy(F.lit(1)))
    buckets = docs.select("bucket").distinct().select("bucket", F.coalesce(before, last).alias("goes_to"))
    # Both uses of the dealt rows read one shuffle of the texts.
    dealt = docs.repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    rows = dealt.select("doc_id", "text", "bucket", sketch(F.col("text"), k).alias("sketch")).withColumns(
        {"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}
    )
    heads = dealt.withColumn("row", F.row_number().over(order)).filter("row = 1").join(buckets, "bucket")
    heads = heads.select(F.col("goes_to").alias("bucket"), F.col("text").alias("head_text"))
    heads = heads.withColumn("head_sketch", sketch(F.col("head_text"), k))
    joined = rows.join(heads, "bucket")
    last_row = F.col("next_text").isNull()
    return joined.select(
        "doc_id",
        "text",
        "sketch",
        F.when(last_row, F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last_row, F.col("head_sketch")).otherwise(F.col("next_sketch")).alias("next_sketch"),
    )


def compare_edited(df: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses.

    The edited text ends in the beginning of the next document instead of its own last
    quarter. Empty texts have an empty fingerprint; a single document is its own successor.
    """
    rows = with_next(df.select("doc_id", whole_text().alias("text")), k)
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
        F.substring(F.col("next_text"), F.lit(1), quarter),
    )
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
    )
