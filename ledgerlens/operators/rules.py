"""Association-rule mining.

Rows become item arrays, and equal arrays are counted first (with map-side combine), so
everything after the first aggregation works on distinct baskets. Their number is
bounded by the product of a dozen small category sets, whatever the ledger's size. Rule
tables are bounded by the item alphabet alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.quantiles import count_values, exact_quantiles, values_at_ranks
from ledgerlens.session import cut_lineage

CANDIDATES_AT_ONCE = 50_000

RULE_ORDER = (F.desc, "lift"), (F.desc, "confidence"), (F.desc, "support"), (F.asc, "antecedents_str"), (F.asc, "consequents_str")


def rule_order() -> list[Column]:
    return [direction(column) for direction, column in RULE_ORDER]


# --- discretisation ----------------------------------------------------------------


def fit_quantile_bins(df: DataFrame, columns: Sequence[str], q: int = 5) -> dict[str, list[float]]:
    """Distinct quantile edges per column; columns without two different values are left out."""
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, {c: F.col(c).try_cast("double") for c in columns}, probs)
    unique = {c: sorted({e for e in es if e is not None}) for c, es in edges.items()}
    return {c: es for c, es in unique.items() if len(es) > 1}


def _labels(bins: int) -> Sequence[str]:
    return fixed.BIN_LABELS.get(bins) or [f"bin_{i}" for i in range(bins)]


def quantile_bin(column: str, edges: Sequence[float]) -> Column:
    """Bin label of a value: right-closed bins between the surviving edges."""
    labels = _labels(len(edges) - 1)
    x = F.col(column).try_cast("double")
    chain = None
    for edge, label in zip(edges[1:-1], labels):
        step = (x <= F.lit(edge), F.lit(f"{column}_{label}"))
        chain = F.when(*step) if chain is None else chain.when(*step)
    last = F.lit(f"{column}_{labels[-1]}")
    return F.when(x.isNotNull(), last if chain is None else chain.otherwise(last))


def quantile_bins(df: DataFrame, columns: Sequence[str], q: int = 5) -> DataFrame:
    """Add ``<column>_bin`` for every column that has at least two different values."""
    fitted = fit_quantile_bins(df, columns, q)
    return df.withColumns({f"{c}_bin": quantile_bin(c, e) for c, e in fitted.items()})


def _rank_boundaries(df: DataFrame, column: str, key: str, q: int) -> list[tuple[float, str | None]]:
    """Value, and key where equal values are divided, of the last row in each rank bin but the top one.

    Ranks follow (value, key). Values come from exact order statistics; only where a
    boundary falls inside a group of equal values are that group's keys put in order.
    """
    total = count_values(df, column)
    if not total:
        return []
    ranks = [(total - 1) * i // q for i in range(1, q)]
    values = values_at_ranks(df, column, ranks)
    x = F.col(column).cast("double")
    around = df.agg(
        *[F.count(F.when(x < v, 1)).alias(f"below{i}") for i, v in enumerate(values)],
        *[F.count(F.when(x == v, 1)).alias(f"equal{i}") for i, v in enumerate(values)],
    ).first()
    boundaries = []
    for i, (rank, value) in enumerate(zip(ranks, values)):
        place = rank - around[f"below{i}"]
        divided = None
        if place < around[f"equal{i}"] - 1:
            ordered = with_global_index(df.filter(x == F.lit(value)).select(key), key, name="_at")
            divided = ordered.filter(F.col("_at") == place).first()[key]
        boundaries.append((value, divided))
    return boundaries


def quantile_bins_fixed_labels(df: DataFrame, columns: Sequence[str], key: str, q: int = 5) -> DataFrame:
    """Always ``q`` labels: where edges coincide, equal-sized bins of the rank (ties by key) instead."""
    fitted = fit_quantile_bins(df, columns, q)
    added = {}
    for column in columns:
        edges = fitted.get(column, [])
        if len(edges) == q + 1:
            added[f"{column}_bin"] = quantile_bin(column, edges)
            continue
        x = F.col(column).cast("double")
        beyond = [
            (x > F.lit(value)) | ((x == F.lit(value)) & (F.col(key) > F.lit(divided)) if divided is not None else F.lit(False))
            for value, divided in _rank_boundaries(df, column, key, q)
        ]
        names = F.array(*[F.lit(f"{column}_{label}") for label in _labels(q)])
        place = reduce(lambda a, b: a + b, [c.cast("int") for c in beyond], F.lit(0))
        added[f"{column}_bin"] = F.get(names, F.when(x.isNotNull() & ~F.isnan(x), place))
    return df.withColumns(added)


# --- baskets -----------------------------------------------------------------------


def _yes_no(column: str, item: str) -> list[Column]:
    flag = F.col(column).cast("int")
    return [F.when(flag == 1, f"{item}_yes"), F.when(flag == 0, f"{item}_no")]


def basket_items(df: DataFrame, bins: Mapping[str, Column], structural: str = "is_birch_hdbscan_outlier") -> Column:
    """All items of a row as a sorted array; items follow from the columns that exist."""
    have = set(df.columns)
    items: list[Column] = []
    kind = next((c for c in ("type", "transaction_type") if c in have), None)
    if kind:
        items.append(F.concat(F.lit("type_"), F.col(kind)))
    else:
        items += [F.when(F.col(c).cast("int") == 1, c) for c in df.columns if c.startswith("type_")]
    for column, item in (("isFraud", "isFraud"), ("isDestMerchant", "dest_merchant"), ("origDrainedToZero", "orig_drained")):
        if column in have:
            items += _yes_no(column, item)
    if "cluster_kmeans" in have:
        items.append(F.concat(F.lit("cluster_kmeans_"), F.col("cluster_kmeans").cast("string")))
    if structural in have:
        mark = F.col(structural).cast("int")
        items += [F.when(mark == 1, "hdbscan_outlier"), F.when(mark == 0, "hdbscan_normal")]
    items += list(bins.values())
    return F.array_sort(F.array_compact(F.array(*items)))


def build_basket(df: DataFrame, columns: Sequence[str] = fixed.BINNED_COLUMNS, q: int = 5) -> DataFrame:
    """Add the ``items`` array of every row, fitting the quantile bins on the whole table."""
    fitted = fit_quantile_bins(df, [c for c in columns if c in df.columns], q)
    return df.withColumn("items", basket_items(df, {c: quantile_bin(c, e) for c, e in fitted.items()}))


def build_basket_fixed_labels(df: DataFrame, key: str, structural: str, columns: Sequence[str] = fixed.BINNED_COLUMNS) -> DataFrame:
    binned = quantile_bins_fixed_labels(df, columns, key)
    return binned.withColumn("items", basket_items(binned, {c: F.col(f"{c}_bin") for c in columns}, structural))


def collapse_baskets(baskets: DataFrame) -> DataFrame:
    """Distinct baskets with their row counts, stored: all mining starts from this small table."""
    return cut_lineage(baskets.groupBy("items").agg(F.count("*").alias("n")))


def basket_total(collapsed: DataFrame) -> int:
    return collapsed.agg(F.sum("n")).first()[0] or 0


# --- supports ----------------------------------------------------------------------


def item_support(collapsed: DataFrame) -> DataFrame:
    """Share of rows holding each item, most frequent first."""
    total = basket_total(collapsed)
    counted = collapsed.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n"))
    return counted.select("item", (F.col("n") / F.lit(total)).alias("support")).orderBy(F.desc("support"), "item")


def important_item_support(collapsed: DataFrame, items: Sequence[str] = fixed.IMPORTANT_ITEMS) -> DataFrame:
    return item_support(collapsed).filter(F.col("item").isin(*items))


def _bitmaps(collapsed: DataFrame, items: Sequence[str]) -> DataFrame:
    """Chunks of distinct baskets turned upright: one bit per basket for each item, and for each binary digit of the row counts."""
    alphabet = pa.array(items, pa.string())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, counts = batch.column(0), batch.column(1).to_numpy()
            at = pc.index_in(lists.flatten(), alphabet)
            owner = pc.list_parent_indices(lists).to_numpy()
            known = at.is_valid().to_numpy(zero_copy_only=False)
            held = np.zeros((len(items), batch.num_rows), bool)
            held[at.fill_null(0).to_numpy()[known], owner[known]] = True
            used = np.flatnonzero(held.any(axis=1))
            digits = range(int(counts.max()).bit_length())
            planes = np.stack([np.packbits((counts >> d) & 1 == 1) for d in digits]) if len(digits) else np.empty((0, 1), np.uint8)
            names = [[items[i] for i in used]]
            columns = [
                pa.array(names, pa.list_(pa.string())), pa.array([np.packbits(held[used], axis=1).tobytes()], pa.binary()),
                pa.array([planes.tobytes()], pa.binary()), pa.array([-(-batch.num_rows // 8)], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["names", "bits", "planes", "width"])

    return collapsed.select("items", "n").mapInArrow(run, "names array<string>, bits binary, planes binary, width int")


def _counted(chunks: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Rows that hold all items of a candidate, for candidates held at all: bitmaps are joined by AND, row counts summed by popcount."""
    by_prefix: dict[tuple, list[str]] = {}
    for c in candidates:
        by_prefix.setdefault(tuple(c[:-1]), []).append(c[-1])

    def run(batches):
        for batch in batches:
            for names, bits, planes, width in zip(*(c.to_pylist() for c in batch.columns)):
                place = {name: i for i, name in enumerate(names)}
                rows = np.frombuffer(bits, np.uint8).reshape(-1, width)
                digits = np.frombuffer(planes, np.uint8).reshape(-1, width)
                found, counts = [], []
                for prefix, ends in by_prefix.items():
                    ends = [e for e in ends if e in place]
                    if not ends or any(p not in place for p in prefix):
                        continue
                    common = np.bitwise_and.reduce(rows[[place[p] for p in prefix]], axis=0)
                    joint = rows[[place[e] for e in ends]] & common
                    total = np.zeros(len(ends), np.int64)
                    for d, plane in enumerate(digits):
                        total += np.bitwise_count(joint & plane).sum(axis=1, dtype=np.int64) << d
                    for end, n in zip(ends, total.tolist()):
                        if n:
                            found.append([*prefix, end])
                            counts.append(n)
                columns = [pa.array(found, pa.list_(pa.string())), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["itemsets", "n"])

    return chunks.mapInArrow(run, "itemsets array<string>, n bigint").groupBy("itemsets").agg(F.sum("n").alias("n"))


def itemset_candidates(level: DataFrame, size: int) -> DataFrame:
    """Itemsets of ``size`` items all of whose parts of one item less are in ``level``; items rise in a set."""
    head = F.slice("itemsets", 1, size - 2)
    left = level.select(head.alias("head"), F.col("itemsets").alias("left"))
    right = level.select(head.alias("head"), F.element_at("itemsets", -1).alias("last"))
    joined = left.join(right, "head").filter(F.element_at("left", -1) < F.col("last"))
    candidates = joined.select(F.concat("left", F.array("last")).alias("candidate"))
    if size == 2:
        return candidates
    parts = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter("candidate", lambda x, j: i != j))
    checked = candidates.select("candidate", F.explode(parts).alias("itemsets")).join(level.select("itemsets"), "itemsets")
    return checked.groupBy("candidate").count().filter(F.col("count") == size).select("candidate")


def frequent_itemsets(collapsed: DataFrame, min_support: float, max_len: int = 3) -> DataFrame:
    """Itemsets of up to ``max_len`` items held by at least ``min_support`` of all rows.

    Level by level: candidates are sets all of whose smaller parts are frequent, and only
    these are counted, on one bitmap per item and chunk of distinct baskets. At most
    ``CANDIDATES_AT_ONCE`` candidates are counted in one pass over the bitmaps.
    """
    total = basket_total(collapsed)
    share = F.col("n") / F.lit(total)
    singles = collapsed.select("n", F.explode(F.array_distinct("items")).alias("item")).groupBy(F.array("item").alias("itemsets"))
    level = cut_lineage(singles.agg(F.sum("n").alias("n")).filter(share >= min_support))
    levels = [level]
    items = sorted(r["itemsets"][0] for r in level.collect())  # an item takes min_support of the rows at least
    if items and max_len > 1:
        chunks = cut_lineage(_bitmaps(collapsed, items))
        for size in range(2, max_len + 1):
            counted, waiting = [], itemset_candidates(level, size).toLocalIterator()
            while block := [list(r[0]) for r in islice(waiting, CANDIDATES_AT_ONCE)]:
                counted.append(cut_lineage(_counted(chunks, block).filter(share >= min_support)))
            if not counted:
                break
            level = reduce(DataFrame.unionByName, counted)
            levels.append(level)
    supported = reduce(DataFrame.unionByName, levels).withColumn("support", share)
    return supported.withColumn("itemsets_str", F.array_join("itemsets", ", ")).orderBy(F.desc("support"), "itemsets_str")


# --- rules -------------------------------------------------------------------------


def association_rules(itemsets: DataFrame, total: int, min_confidence: float = 0.5, min_lift: float = 1.2) -> DataFrame:
    """Every split of every frequent itemset into two sides, with the usual measures.

    Subsets of a frequent itemset are frequent themselves, so both sides always find
    their support in the same table.
    """
    sides = itemsets.select("itemsets", "n", F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), F.size("itemsets")).cast("int") - 2)).alias("mask")).filter(
        F.size("itemsets") > 1
    )
    split = sides.select(
        "n",
        F.expr("filter(itemsets, (x, i) -> getbit(mask, i) = 1)").alias("antecedents"),
        F.expr("filter(itemsets, (x, i) -> getbit(mask, i) = 0)").alias("consequents"),
    ).withColumns({"antecedents_str": F.array_join("antecedents", ", "), "consequents_str": F.array_join("consequents", ", ")})
    known = itemsets.select(F.array_join("itemsets", ", ").alias("_side"), F.col("n").alias("_count"))
    left = known.select(F.col("_side").alias("antecedents_str"), F.col("_count").alias("n_antecedent"))
    right = known.select(F.col("_side").alias("consequents_str"), F.col("_count").alias("n_consequent"))
    joined = split.join(left, "antecedents_str").join(right, "consequents_str")
    rows = F.lit(float(total))
    measured = joined.withColumns(
        {
            "antecedent_len": F.size("antecedents"),
            "consequent_len": F.size("consequents"),
            "antecedent_support": F.col("n_antecedent") / rows,
            "consequent_support": F.col("n_consequent") / rows,
            "support": F.col("n") / rows,
            "confidence": F.col("n") / F.col("n_antecedent"),
        }
    ).withColumns(
        {
            "lift": F.col("confidence") / F.col("consequent_support"),
            "leverage": F.col("support") - F.col("antecedent_support") * F.col("consequent_support"),
            "conviction": F.when(F.col("n") == F.col("n_antecedent"), F.lit(float("inf"))).otherwise(
                F.try_divide(1 - F.col("consequent_support"), 1 - F.col("confidence"))
            ),
        }
    )
    kept = measured.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    columns = (
        "antecedents", "consequents", "antecedents_str", "consequents_str", "antecedent_len", "consequent_len",
        "antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage", "conviction",
    )
    return kept.select(*columns).orderBy(*rule_order())


def mine(collapsed: DataFrame, min_support: float = 0.005, max_len: int = 3, min_confidence: float = 0.5, min_lift: float = 1.2) -> DataFrame:
    """Itemsets and rules of a support level. Both are small and used several times, so both are stored."""
    itemsets = cut_lineage(frequent_itemsets(collapsed, min_support, max_len))
    return cut_lineage(association_rules(itemsets, basket_total(collapsed), min_confidence, min_lift))


def mentions(column: str, words: Sequence[str]) -> Column:
    """True where the joined text contains any of the words."""
    return reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(w)) for w in words])


def meaningful_rules(rules: DataFrame) -> DataFrame:
    """Rules whose outcome is not a commonplace and says something useful."""
    outcome = "consequents_str"
    wanted = mentions(outcome, fixed.USEFUL_CONSEQUENTS) & ~mentions(outcome, fixed.TRIVIAL_CONSEQUENTS)
    return rules.filter(wanted).orderBy(*rule_order())


def report_rules(rules: DataFrame, min_confidence: float = 0.30, min_lift: float = 1.20) -> DataFrame:
    strong = (F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)
    return rules.filter(~F.col("consequents_str").rlike("|".join(fixed.TRIVIAL_CONSEQUENTS)) & strong).orderBy(*rule_order())


def fraud_rules(collapsed: DataFrame, min_support: float = 0.0001, min_lift: float = 1.2, max_len: int = 3) -> DataFrame:
    """Low-support rules that lead to the fraud label."""
    rules = mine(collapsed, min_support, max_len, 0.0, min_lift)
    to_fraud = mentions("consequents_str", ["isFraud_yes"]) & ~mentions("antecedents_str", ["isFraud_no"])
    return rules.filter(to_fraud).orderBy(*rule_order())


def general_and_fraud_rules(collapsed: DataFrame, min_support: float = 0.005, fraud_support: float = 0.0008, min_fraud_rows: int = 5) -> DataFrame:
    """General rules plus low-support rules towards fraud, without repeats, strongest first."""
    columns = ("antecedents_str", "consequents_str", "support", "confidence", "lift")
    found = mine(collapsed, min_support).select(*columns)
    fraud_rows = collapsed.filter(F.array_contains("items", "isFraud_yes")).agg(F.sum("n")).first()[0] or 0
    if fraud_rows >= min_fraud_rows:
        low = mine(collapsed, fraud_support, 3, 0.0, 1.2).filter(F.array_contains("consequents", "isFraud_yes"))
        found = found.unionByName(low.select(*columns))
    return found.dropDuplicates(["antecedents_str", "consequents_str"]).orderBy(*rule_order())


def rules_mentioning(rules: DataFrame, item: str, n: int = 5) -> DataFrame:
    either = F.contains(F.col("antecedents_str"), F.lit(item)) | F.contains(F.col("consequents_str"), F.lit(item))
    return rules.filter(either).orderBy(*rule_order()).limit(n)


def _ranked(rules: DataFrame, source: int) -> DataFrame:
    """Rule lists are small (see above), so one ordered window numbers them."""
    return rules.withColumns(
        {"_source": F.lit(source), "_at": F.row_number().over(Window.orderBy(*rule_order()))}
    )


def _first_distinct(parts: Sequence[DataFrame], n: int) -> DataFrame:
    """Concatenate ranked lists in source order, drop later repeats, keep the first ``n``."""
    stacked = reduce(DataFrame.unionByName, parts)
    same_rule = Window.partitionBy("antecedents_str", "consequents_str").orderBy("_source", "_at")
    firsts = stacked.withColumn("_copy", F.row_number().over(same_rule)).filter(F.col("_copy") == 1)
    picked = firsts.orderBy("_source", "_at").limit(n)
    position = F.row_number().over(Window.orderBy("_source", "_at"))
    return picked.withColumn("position", position).drop("_source", "_at", "_copy")


def select_top10(fraud: DataFrame, report: DataFrame, n: int = 10) -> DataFrame:
    """Four fraud, two outlier, two cluster and five other rules; report rules fill up to ``n``."""
    outcome = "consequents_str"
    quotas = fixed.TOP_RULE_QUOTAS
    pieces = [
        (fraud, quotas["fraud"]),
        *[(report.filter(mentions(outcome, [word])), quotas[word]) for word in ("hdbscan_outlier", "cluster_kmeans")],
        (report.filter(~mentions(outcome, fixed.TOP_RULE_OUTCOMES)), quotas["other"]),
    ]
    parts = [_ranked(rules, i).filter(F.col("_at") <= k) for i, (rules, k) in enumerate(pieces)]
    return _first_distinct([*parts, _ranked(report, len(parts))], n)


def clean_top10(top: DataFrame, report: DataFrame, n: int = 10) -> DataFrame:
    """Drop rules with commonplace conditions and refill from the report rules."""
    usable = ~mentions("antecedents_str", fixed.TRIVIAL_ANTECEDENTS)
    kept = top.filter(usable).withColumns({"_source": F.lit(0), "_at": F.col("position")}).drop("position")
    return _first_distinct([kept, _ranked(report.filter(usable), 1)], n)
