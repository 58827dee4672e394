"""Sampling with sizes that hold exactly and results that do not depend on partitioning.

Rows are ordered by a hash of their id that any engine can compute (MD5). A sample of a
stratum is its first rows in that order: everything below a cut. The cuts of all strata
are found together, as order statistics: a bracket that should hold the cut follows from
quota and size, rows are counted below, in and above it, and what is in a bracket is
narrowed by counts per part of it until few values are left. No stratum is sorted or ranked,
and there may be as many strata as there are rows. Rows with one id are told apart by a
hash of the whole row; of rows that are equal altogether any will do, and they are numbered
partition by partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage, pin_layout

HASH_DIGITS = 15
HASH_END = 16**HASH_DIGITS
PARTS = 256
DIRECT = 5_000
SIGMAS = 8.0


def unit_hash(keys: Sequence[str], seed: int) -> Column:
    """A repeatable number in [0, 1) per row id."""
    return (F.xxhash64(F.lit(seed), *keys).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """Where a row comes: the first 15 hexadecimal digits of the MD5 of seed and id, joined by bars."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_DIGITS), 16, 10).cast("bigint")


def row_order(df: DataFrame) -> Column:
    """A second order, by the whole row, over the same range."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(HASH_END))


def _narrowed(values: DataFrame, state: DataFrame, total: int) -> DataFrame:
    """One round: split every bracket into parts, count them, and keep the part that holds the cut.

    ``state`` has stratum, low, high (the bracket, high excluded), need (rows to take from
    low on, at least one) and n; ``values`` has stratum and v. A part may also be all below or above.
    """
    placed = join_by_key(values, state, ["stratum"], "n", "inner", total=total)
    width = F.greatest(F.lit(1).cast("bigint"), F.ceil((F.col("high") - F.col("low")) / PARTS).cast("bigint"))
    part = F.when(F.col("v") < F.col("low"), -1).when(F.col("v") >= F.col("high"), PARTS)
    part = part.otherwise(F.floor((F.col("v") - F.col("low")) / width)).cast("int")
    counts = placed.groupBy("stratum", part.alias("part")).agg(
        F.count("*").alias("rows"), F.first("low").alias("low"), F.first("high").alias("high"), F.first("need").alias("need"), F.first(width).alias("width")
    )
    before = F.sum("rows").over(Window.partitionBy("stratum").orderBy("part"))  # PARTS + 2 rows a stratum
    crossing = counts.withColumn("upto", before).filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("rows") < F.col("need")))
    inside = F.col("low") + F.col("part") * F.col("width")
    return crossing.select(
        "stratum",
        F.when(F.col("part") < 0, 0).when(F.col("part") == PARTS, F.col("high")).otherwise(inside).cast("bigint").alias("low"),
        F.when(F.col("part") < 0, F.col("low")).when(F.col("part") == PARTS, HASH_END)
        .otherwise(F.least(inside + F.col("width"), F.col("high"))).cast("bigint").alias("high"),
        (F.col("need") - F.col("upto") + F.col("rows")).alias("need"),
        F.col("rows").alias("n"),
    )


def _within(values: DataFrame, state: DataFrame, total: int) -> DataFrame:
    """The values inside their stratum's bracket."""
    placed = join_by_key(values, state.select("stratum", "low", "high", "n"), ["stratum"], "n", "inner", total=total)
    return placed.filter((F.col("v") >= F.col("low")) & (F.col("v") < F.col("high"))).select("stratum", "v")


def cuts(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """stratum, cut, take, ties: the first ``quota`` values of each stratum are those below ``cut`` and ``take`` of the ``ties`` equal to it.

    ``values`` has stratum and v, whole numbers from 0 to ``HASH_END``; ``wanted`` has stratum,
    n (its rows) and quota, from 1 to n.
    """
    total = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share, n = F.col("quota") / F.col("n"), F.col("n")
    slack = F.lit(SIGMAS) * F.sqrt(share * (1 - share) / n) + 2 / n
    state = wanted.select(
        "stratum",
        F.floor(F.greatest(F.lit(0.0), share - slack) * F.lit(float(HASH_END))).cast("bigint").alias("low"),
        F.least(F.lit(HASH_END), F.ceil((share + slack) * F.lit(float(HASH_END))).cast("bigint")).alias("high"),
        F.col("quota").cast("bigint").alias("need"),
        "n",
    )
    small = F.col("n") <= DIRECT
    whole = state.withColumns({
        "low": F.when(small, F.lit(0).cast("bigint")).otherwise(F.col("low")),
        "high": F.when(small, F.lit(HASH_END)).otherwise(F.col("high")),
    })
    # The first bracket is a guess, so its rows below count as a part of their own.
    done, state, rows = None, whole, values
    while True:
        settled = (F.col("n") <= DIRECT) | (F.col("high") - F.col("low") <= 1)
        ready = state.filter(settled)
        found = _direct(_within(rows, ready, total), ready)
        done = cut_lineage(found if done is None else done.unionByName(found))
        state = cut_lineage(_narrowed(rows, state.filter(~settled), total))
        total = state.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not total:
            return done
        rows = cut_lineage(_within(rows, state, total))


def _direct(values: DataFrame, state: DataFrame) -> DataFrame:
    """The cut in brackets with few rows, or with one value only."""
    counted = values.groupBy("stratum", "v").agg(F.count("*").alias("ties"))
    placed = counted.join(state.select(F.col("stratum").alias("_s"), "need"), F.col("stratum").eqNullSafe(F.col("_s"))).drop("_s")
    upto = F.sum("ties").over(Window.partitionBy("stratum").orderBy("v"))  # at most DIRECT values a stratum
    crossing = placed.withColumn("upto", upto).filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("ties") < F.col("need")))
    return crossing.select("stratum", F.col("v").alias("cut"), (F.col("need") - F.col("upto") + F.col("ties")).alias("take"), "ties")


def _taken(rows: DataFrame, wanted: DataFrame, orders: Sequence[Column]) -> DataFrame:
    """The first ``quota`` rows of every stratum by the first order, ties by the next, then any. ``rows`` has ``_row`` and ``stratum``."""
    if not orders:
        numbered = _numbered_by_layout(rows)
        at = numbered.join(wanted.select(F.col("stratum").alias("_s"), "quota"), F.col("stratum").eqNullSafe(F.col("_s")))
        return at.filter(F.col("_place") < F.col("quota")).select("stratum", "_row")
    valued = rows.withColumn("v", orders[0])
    found = cuts(valued.select("stratum", "v"), wanted)
    sized = cut_lineage(found.join(wanted.select(F.col("stratum").alias("_s"), "n"), F.col("stratum").eqNullSafe(F.col("_s"))).drop("_s"))
    placed = join_by_key(valued, sized, ["stratum"], "n", "inner")
    whole = F.col("v") < F.col("cut") + F.when(F.col("take") == F.col("ties"), 1).otherwise(0)
    split = sized.filter(F.col("take") < F.col("ties"))
    kept = placed.filter(whole).select("stratum", "_row")
    if split.isEmpty():
        return kept
    tied = placed.filter((F.col("v") == F.col("cut")) & (F.col("take") < F.col("ties"))).select("stratum", "_row")
    left = split.select("stratum", F.col("ties").alias("n"), F.col("take").alias("quota"))
    return kept.unionByName(_taken(cut_lineage(tied), cut_lineage(left), orders[1:]))


def _numbered_by_layout(rows: DataFrame) -> DataFrame:
    """Rows with their place in their stratum, counted through the partitions as they are; for equal rows only."""
    laid_out = pin_layout(rows).withColumn("_part", F.spark_partition_id())
    sizes = laid_out.groupBy("stratum", "_part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("stratum").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("stratum").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("stratum", "_part").orderBy(F.lit(0)))
    counted = laid_out.withColumn("_in", inside)
    same = F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))
    return counted.join(starts, same).withColumn("_place", F.col("_start") + F.col("_in") - 1).drop("_s", "_p", "_start", "_in", "_part")


def stratified(df: DataFrame, stratum: Column, quota: Callable[[Column, Column], Column], keys: Sequence[str], seed: int) -> DataFrame:
    """Exactly min(quota, rows) rows of every stratum; ``quota`` is given its rows and all rows."""
    sizes = cut_lineage(df.groupBy(stratum.alias("stratum")).agg(F.count("*").alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = sizes.withColumn("quota", F.least("n", quota(F.col("n"), F.lit(total)).cast("bigint"))).filter("quota > 0")
    rows = df.select(stratum.alias("stratum"), F.struct("*").alias("_row"), hash_order(keys, seed).alias("_h"), row_order(df).alias("_r"))
    rows = rows.withColumn("_row", F.struct("_row", "_h", "_r"))
    orders = [F.col("_row._h"), F.col("_row._r")]
    return _taken(rows.select("stratum", "_row"), wanted, orders).select("_row._row.*")


def stratified_proportional(df: DataFrame, stratum: str, keys: Sequence[str], size: int = 300_000, seed: int = 42) -> DataFrame:
    """A sample of about ``size`` rows: the whole part of size times the stratum's share from each."""
    return stratified(df, F.col(stratum), lambda n, total: F.floor(F.lit(size) * (n / total)), keys, seed)


def stratified_fixed(df: DataFrame, stratum: str, keys: Sequence[str], per_stratum: int = 5_000, seed: int = 42) -> DataFrame:
    return stratified(df, F.col(stratum), lambda n, total: F.lit(per_stratum), keys, seed)


def stratified_fraction(df: DataFrame, stratum: str, keys: Sequence[str], max_points: int = 3_000, seed: int = 42) -> DataFrame:
    """Cut a point set to about ``max_points``, at least one point per stratum; small sets stay whole."""
    if df.count() <= max_points:
        return df
    return stratified(df, F.col(stratum), lambda n, total: F.greatest(F.lit(1), F.floor(n * (F.lit(max_points) / total))), keys, seed)


def bernoulli_percent(df: DataFrame, max_points: int = 3_000, seed: int = 42) -> DataFrame:
    """Independent row sample of at least one percent, only for more than ``max_points`` rows."""
    total = df.count()
    if total <= max_points:
        return df
    percent = round(max(1.0, max_points / total * 100), 2)
    return df.sample(fraction=percent / 100, seed=seed)


def fixed_size_random(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (all rows when there are fewer)."""
    return stratified(df, F.lit(0), lambda rows, total: F.lit(n), keys, seed)


def systematic_every_k(df: DataFrame, order: Sequence[str], target: int = 100_000) -> DataFrame:
    """Every k-th row of a stated unique order, with k = rows // target but at least 1.

    Only the order columns are sorted and numbered. The picked keys, fewer than twice the
    target, fetch their rows.
    """
    k = max(1, df.count() // target)
    if k == 1:
        return df
    numbered = with_global_index(df.select(*order), *order, name="_n")
    picked = numbered.filter(F.col("_n") % k == 0).drop("_n")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(picked[c]) for c in order])
    return df.join(picked, same, "left_semi")
