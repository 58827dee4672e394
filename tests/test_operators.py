"""Edge rows, and properties that no SQL statement states."""

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions import text
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.operators import anomaly, cleaning, explorer, isolation, quality, risk, rules, sampling, segments
from ledgerlens.operators import cluster_eval
from ledgerlens.operators import cube as cubes
from ledgerlens.operators.filters import Filters, search_mode
from ledgerlens.plans import stages
from ledgerlens.plans.investigation import Investigation
from ledgerlens.plans.registry import collapsed, scored, serving
from ledgerlens.session import cut_lineage, scratch_path
from ledgerlens.sources import ledger, readers, writers


def column(df, name):
    return [r[name] for r in df.collect()]


# --- quantile bins, scaling, thresholds ----------------------------------------------


def test_constant_column_has_no_bins(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "amount double")
    assert rules.fit_quantile_bins(df, ["amount"]) == {}
    assert rules.quantile_bins(df, ["amount"]).columns == ["amount"]


@pytest.mark.parametrize(
    "values,labels",
    [
        ([0.0] * 12 + [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], ("low", "medium", "high")),
        ([0.0] * 14 + [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], ("low", "high")),
        ([0.0] * 19 + [5.0], ("all",)),
        (list(map(float, range(10))), ("very_low", "low", "medium", "high", "very_high")),
    ],
)
def test_equal_edges_collapse(spark, values, labels):
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    found = set(column(rules.quantile_bins(df, ["amount"]), "amount_bin"))
    assert found == {f"amount_{label}" for label in labels}


def test_bins_of_text_numbers_and_nulls(spark):
    df = spark.createDataFrame([(str(i),) for i in range(10)] + [("none",), (None,)], "x string")
    bins = column(rules.quantile_bins(df, ["x"]), "x_bin")
    assert bins[:2] == ["x_very_low"] * 2 and bins[-2:] == [None, None]


def test_zero_spread_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(6.0,)], "a double")
    assert cleaning.robust_scale_fit(df, ["a"])["a"] == (5.0, 1.0)
    constant = spark.createDataFrame([(5.0,)] * 3, "a double")
    assert cleaning.standard_scale_fit(constant, ["a"])["a"] == (5.0, 1.0)
    assert set(column(anomaly.zscore_flag(constant, "a", quality.numeric_profile(constant, ["a"], ())["a"]), "flag_ZScore")) == {0}


def test_mismatch_flag_without_columns_is_zero(spark):
    df = spark.createDataFrame([(1.0,)], "amount double")
    assert column(anomaly.balance_mismatch_flag(df, {}), "flag_BalanceMismatch") == [0]


# --- presentation ------------------------------------------------------------------


def test_number_and_label_texts(spark):
    df = spark.createDataFrame([(0.12345, 1234567.5, "CASH_IN", 25), (None, None, "NEW_KIND", None)], "a double, b double, t string, s int")
    shown = df.select(
        text.format_pct(F.col("a"), 1), text.format_int(F.col("b")), text.format_rupiah(F.col("b"), 1), text.format_multiplier(F.col("b")),
        text.humanize_type(F.col("t")), text.step_to_day_hour(F.col("s")),
    ).collect()
    assert tuple(shown[0]) == ("12,3%", "1.234.568", "Rp1.234.567,5", "1,234,567,5x", "Setor Tunai", "Hari ke-2, 00:00")
    assert tuple(shown[1]) == ("-", "-", "-", "-", "New Kind", "-")


def test_item_texts(spark):
    df = spark.createDataFrame([("isFraud_yes, type_DEBIT",), ("odd_item",), ("",)], "i string")
    texts = column(df.select(text.humanize_items(F.col("i")).alias("t")), "t")
    assert texts == ["berstatus fraud terkonfirmasi DAN transaksi debit", "odd item", "-"]


def test_destination_type_encodings(spark):
    df = spark.createDataFrame([(v,) for v in ("True", "1", "1.0", " M ", "merchant", "yes", "Y", "0", "no", None)], "f string")
    found = column(df.select(cleaning.derive_dest_type(F.col("f")).alias("t")), "t")
    assert found == [fixed.DEST_MERCHANT] * 7 + [fixed.DEST_CUSTOMER] * 3


def test_first_maximum_wins_in_inverse_one_hot(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 0)], "type_A int, type_B int, type_C int")
    assert column(cleaning.inverse_one_hot(df, "type_", "t"), "t") == ["B", "A"]


def test_standardize_fills_only_what_is_absent(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 1, 0, 3, 1, 1, 5.0), (0, 0, 0, 0, 1, 0, 0, 0, 6.0)],
        "flag_IQR int, flag_ZScore int, flag_IsoForest int, flag_HDBSCAN int, flag_BalanceMismatch int, risk_score int, type_A int, isFraud int, amount double",
    ).withColumn("type_B", 1 - F.col("type_A"))
    rows = cleaning.standardize_schema(df, "amount").orderBy("amount").collect()
    assert [r["transaction_type"] for r in rows] == ["A", "B"]
    assert [r["transaction_id"] for r in rows] == ["TX00000000", "TX00000001"]
    assert [r["high_risk"] for r in rows] == [True, False]
    assert [r["jenis_tujuan"] for r in rows] == ["Nasabah"] * 2
    assert [r["anomaly_type"] for r in rows] == ["Klaster Menyimpang (Outlier)", "Ketidaksesuaian Saldo"]
    assert rows[0]["anomaly_reason"] == "Nominal tinggi tak wajar (IQR); Menyimpang dari struktur klaster (BIRCH+HDBSCAN)"


# --- scoring -----------------------------------------------------------------------


def test_no_positive_prediction_gives_zero_precision(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "isFraud int, high_risk int")
    values = {r["metric"]: r["value"] for r in risk.validation_metrics(df).collect()}
    assert (values["Precision"], values["Recall"], values["F1"]) == (0.0, 0.0, 0.0)
    assert values["High Risk Fraud Rate"] is None


@pytest.mark.parametrize("n", [1, 40, 700, 10_000])
def test_top_rows_equal_a_full_sort(spark, folder, n):
    rows = cut_lineage(scored(spark, folder))
    order = [F.desc(c) for c in (*risk.TOP_ORDER, "amount")] + [F.asc("transaction_id")]
    assert column(risk.top_anomalies(rows, n), "transaction_id") == column(rows.orderBy(*order).limit(n), "transaction_id")


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(1)
    values = [(f"r{i:05d}", *map(float, rng.normal(size=3))) for i in range(3000)] + [(f"odd{i}", 40.0 + i, -50.0, 60.0) for i in range(5)]
    df = spark.createDataFrame(values, "id string, amount double, origError double, destError double")
    flagged = isolation.isolation_forest_flag(df, ["id"], trees=40)
    marked = {r["id"] for r in flagged.filter("flag_IsoForest = 1").collect()}
    assert {f"odd{i}" for i in range(5)} <= marked
    assert abs(len(marked) / 3005 - 0.01) < 0.002
    again = isolation.isolation_forest_flag(df.repartition(7), ["id"], trees=40)
    assert marked == {r["id"] for r in again.filter("flag_IsoForest = 1").collect()}


# --- sampling and numbering ----------------------------------------------------------


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 * F.col("id") % 2).alias("kind"))
    one = sampling.fixed_size_random(df, 300, ["id"])
    two = sampling.fixed_size_random(df.repartition(9), 300, ["id"])
    assert one.count() == 300 and set(column(one, "id")) == set(column(two, "id"))


def test_sample_is_full_even_for_repeated_ids(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("id"))
    assert sampling.fixed_size_random(df, 100, ["id"]).count() == 100


def test_global_index_is_consecutive(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3 == 0).alias("hot")).repartition(6)
    rows = with_global_index(df, "hot", "v").collect()
    assert [r["v"] for r in sorted(rows, key=lambda r: r["row_index"])] == [r["v"] for r in sorted(rows, key=lambda r: (r["hot"], r["v"]))]
    assert sorted(r["row_index"] for r in rows) == list(range(1000))


def test_systematic_sample_takes_every_kth(spark):
    df = spark.range(1050).repartition(5)
    assert sorted(column(sampling.systematic_every_k(df, ["id"], 100), "id")) == list(range(0, 1050, 10))


# --- rules -------------------------------------------------------------------------


def test_supports_equal_fpgrowth(spark, folder):
    baskets = collapsed(spark, folder)
    found = {tuple(r["itemsets"]): r["n"] for r in rules.frequent_itemsets(baskets, 0.01).collect()}
    rows = baskets.select("items", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    model = FPGrowth(itemsCol="items", minSupport=0.01, minConfidence=0.9).fit(rows)
    expected = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.filter("size(items) <= 3").collect()}
    assert found == expected


def test_rules_equal_brute_force(spark):
    rng = random.Random(2)
    baskets = [sorted(rng.sample("abcdef", rng.randint(1, 5))) for _ in range(200)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    count = Counter(c for b in baskets for k in (1, 2, 3) for c in combinations(b, k))
    expected = {}
    for itemset, n in count.items():
        for k in range(1, len(itemset)):
            for left in combinations(itemset, k):
                right = tuple(i for i in itemset if i not in left)
                confidence = n / count[left]
                lift = confidence / (count[right] / 200)
                if n / 200 >= 0.05 and confidence >= 0.3 and lift >= 1.01:
                    conviction = math.inf if n == count[left] else (1 - count[right] / 200) / (1 - confidence)
                    expected[", ".join(left), ", ".join(right)] = (confidence, lift, conviction)
    table = rules.collapse_baskets(df)
    found = {
        (r["antecedents_str"], r["consequents_str"]): (r["confidence"], r["lift"], r["conviction"])
        for r in rules.mine(table, 0.05, 3, 0.3, 1.01).collect()
    }
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values)


def test_certain_rule_has_infinite_conviction(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["b"],), (["c"],)], "items array<string>")
    mined = {(r["antecedents_str"], r["consequents_str"]): r for r in rules.mine(rules.collapse_baskets(df), 0.1, 2, 0.5, 1.0).collect()}
    assert mined["a", "b"]["conviction"] == math.inf


# --- segments ----------------------------------------------------------------------


def blobs(spark, per=60):
    rng = np.random.default_rng(4)
    middles = [(0.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    rows = [(f"{b}-{i}", float(x + rng.normal()), float(y + rng.normal()), b) for b, (x, y) in enumerate(middles) for i in range(per)]
    return spark.createDataFrame(rows, "id string, x double, y double, b int")


def test_kmeans_recovers_separate_groups(spark):
    df = blobs(spark)
    labelled = segments.kmeans_segment(df, ["x", "y"], 3, restarts=3)
    pairs = {(r["b"], r["cluster_kmeans"]) for r in labelled.collect()}
    assert len(pairs) == 3


def test_vector_and_column_distances_agree(spark):
    df = blobs(spark).withColumn("v", F.array("x", "y"))
    centres = cluster_eval.nearest_centroid_centres(df, ["x", "y"], "b")
    inline = column(segments.nearest_centroid_assign(df, ["x", "y"], centres), "cluster")
    batched = column(segments.nearest_centroid_assign(df, "v", centres), "cluster")
    assert inline == batched
    a, b = (cluster_eval.cluster_quality(df, f, "b") for f in (["x", "y"], "v"))
    assert a == pytest.approx(b)


def test_sampled_density_clusters_are_measured_in_rows(spark):
    rows = [(i, 0.1, 0.1, "a") for i in range(3_000)] + [(3_000 + i, 9.1, 9.1, "a") for i in range(2_999)]
    df = spark.createDataFrame(rows, "id long, x double, y double, kind string")
    found = segments.density_cluster_sample_predict(df, ["x", "y"], "kind", ["id"], sample_size=len(rows))
    counts = {(r["x"], r["cluster_hdbscan"]): r["count"] for r in found.groupBy("x", "cluster_hdbscan").count().collect()}
    assert counts == {(0.1, 0): 3_000, (9.1, -1): 2_999}


def test_registered_segment_queries_leave_the_operators_defaults(spark, folder, monkeypatch):
    from ledgerlens.plans import segment_queries

    given = {}
    for name in ("k_sweep", "density_cluster_centres", "density_cluster_sample_predict", "segment_projection_table"):
        monkeypatch.setattr(segment_queries.segments, name, lambda df, *args, _name=name, **named: given.update({_name: (args, named)}) or df)
    features = segment_queries.MODEL_FEATURES
    frame = spark.createDataFrame([(0, 0, 0)], "transaction_id long, cluster_birch_hdbscan int, cluster_hdbscan int")
    for name in ("prepared", "serving", "inverse_one_hot"):
        monkeypatch.setattr(segment_queries, name, lambda *_: frame)
    for name in ("k_sweep", "density_cluster_centres", "density_cluster_sample_predict", "segment_projection_table"):
        getattr(segment_queries, name)(spark, folder)
    assert given == {
        "k_sweep": ((features,), {}),
        "density_cluster_centres": ((features,), {}),
        "density_cluster_sample_predict": ((features, "type", ["transaction_id"]), {}),
        "segment_projection_table": ((["transaction_id"],), {}),
    }


def test_projection_matches_an_eigen_decomposition(spark):
    df = blobs(spark)
    points = np.array([(r["x"], r["y"]) for r in df.collect()])
    values, vectors = np.linalg.eigh(np.cov(points.T))
    fit = segments.fit_pca(df, ["x", "y"], 2)
    assert fit.ratios == pytest.approx(sorted(values / values.sum(), reverse=True))
    first = np.array(column(segments.pca_project(df, ["x", "y"], fit), "pc1"))
    assert np.allclose(np.abs(first), np.abs((points - points.mean(axis=0)) @ vectors[:, -1]))


# --- cube and search -----------------------------------------------------------------


@pytest.fixture(scope="module")
def desk(spark, folder):
    rows = serving(spark, folder)
    rules_table = spark.createDataFrame([("POLA0001", "Pola Fraud")], "rule_id string, rule_group string")
    return Investigation(writers.save_serving_tables(rows, cubes.build_cube(rows), rules_table, scratch_path(spark, "desk")))


def random_filters(rng):
    pick = lambda values: tuple(rng.sample(values, rng.randint(0, len(values) - 1)))
    return Filters(
        jenis_tujuan=pick(["Merchant", "Nasabah"]), status_kuras=pick(["Terkuras Habis", "Tidak Terkuras"]),
        jenis_transaksi=pick(list(fixed.TRANSACTION_TYPE_LABELS)), segmen=pick([0, 1, 2, 3, 4]),
        risk_level=pick(list(fixed.RISK_LEVEL_LABELS.values())), risk_score_min=rng.choice([None, 1]), risk_score_max=rng.choice([None, 3]),
    )


@pytest.mark.parametrize("seed", range(4))
def test_cube_and_rows_agree(desk, seed):
    filters = random_filters(random.Random(seed))
    kept = explorer.filter_rows(desk.rows, filters)
    assert desk.count(filters) == kept.count()
    figures = desk.get_kpi(filters).first()
    assert figures["total_fraud"] == kept.filter("isFraud").count()
    assert figures["total_high_risk"] == kept.filter("high_risk").count()


@pytest.mark.parametrize("direction,page", [("desc", 1), ("desc", 7), ("asc", 2)])
def test_pages_read_from_few_levels_equal_full_pages(desk, direction, page):
    filters = Filters(jenis_tujuan=("Nasabah",))
    rows, total = desk.search_transactions(filters, sort_dir=direction, page=page, page_size=20)
    plain = explorer.search_transactions(desk.rows, filters, "risk_score", direction, page, 20)
    assert rows.collect() == plain.collect()
    assert total == explorer.filter_rows(desk.rows, filters).count()


def test_empty_filter_result_has_zero_rates(desk):
    nothing = Filters(jenis_tujuan=("Merchant",), risk_score_min=6)
    row = desk.get_kpi(nothing).first()
    assert (row["total_transaksi"], row["fraud_rate"], row["avg_risk_score"], row["high_risk_fraud_rate"]) == (0, 0.0, 0.0, None)
    assert desk.get_segment_summary(nothing).collect() == []
    assert [r["transactions"] for r in cubes.risk_funnel(desk.cube, nothing).collect()] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize(
    "typed,mode,operand",
    [
        ("TX00000010", "id_exact", "TX00000010"),
        ("tx0000001099", "id_exact", "TX0000001099"),
        ("TX0001", "id_prefix", "TX0001"),
        ("T12", "id_prefix", "TX12"),
        ("hdbscan", "keyword", "flag_HDBSCAN"),
        (" Saldo ", "keyword", "flag_BalanceMismatch"),
        ("amount", "ilike", "amount"),
        ("12", "ilike", "12"),
    ],
)
def test_search_modes(typed, mode, operand):
    assert (search_mode(typed).mode, search_mode(typed).operand) == (mode, operand)


def test_filters_ignore_empty_and_unknown_fields():
    assert Filters.from_dict({"segmen": [1], "search": "", "amount_min": None, "other": 3}) == Filters(segmen=(1,))
    assert Filters.from_dict(None).is_empty()


def test_unknown_sort_column_falls_back_to_score(desk):
    assert explorer.search_transactions(desk.rows, sort_col="1; drop").collect() == explorer.search_transactions(desk.rows).collect()


# --- sources and the whole run ---------------------------------------------------------


def test_first_existing_source(spark, folder):
    assert readers.first_existing_source(spark, ["/nowhere/a", f"{folder}/orders.parquet"]).endswith("orders.parquet")
    with pytest.raises(FileNotFoundError):
        readers.first_existing_source(spark, ["/nowhere/a"], "/nowhere/b")


def test_rule_pool_without_files_is_the_pinned_rules(spark, tmp_path):
    main, pool = readers.multi_csv_rule_pool(spark, str(tmp_path))
    assert main.count() == 10 and pool.count() == 0


def test_scaler_round_trip(spark, tmp_path):
    params = {"a": (1.5, 2.0), "b": (0.1, 1.0)}
    writers.save_scaler(spark, params, str(tmp_path / "scaler"))
    assert writers.load_scaler(spark, str(tmp_path / "scaler")) == params


def test_manifest_appends_a_line_per_run(spark, tmp_path):
    for run in (1, 2):
        stored = writers.run_manifest(spark, str(tmp_path / "manifest"), "batch", {"rows": run})
    assert sorted(column(stored, "rows")) == [1, 2]


def test_all_stages_end_to_end(spark, folder, tmp_path):
    raw = ledger.transactions(spark, folder)
    tables = stages.run(raw, str(tmp_path / "out"), restarts=1, trees=20, threshold=1.5)
    kept = raw.filter("amount > 0").count()
    assert tables["transactions"].count() == kept
    assert tables["cube"].agg(F.sum("n")).first()[0] == kept
    assert {"pca"} == set(column(tables["projection"].select("method").distinct(), "method"))
    report = cubes.serving_table_check(tables["transactions"], tables["cube"], tables["rules"], tables["projection"])
    assert all(column(report, "ok"))
    outliers = readers.load_parquet(spark, str(tmp_path / "out/segments/outliers"))
    clustered = readers.load_parquet(spark, str(tmp_path / "out/clustered"))
    assert quality.subset_consistency(clustered, outliers, "is_birch_hdbscan_outlier").first()["consistent"]
    assert clustered.select("cluster_kmeans").distinct().count() == 5
    desk = Investigation.open(spark, str(tmp_path / "out/serving"))
    assert desk.ping() and desk.count() == kept
    rows, total = desk.search_transactions(Filters(search="TX00000010"))
    assert total == rows.count() == 1
    assert desk.get_segment_projection(method="pca", dim=2).columns == ["proj_x", "proj_y", "cluster_kmeans", "isFraud"]
    assert desk.get_rules(limit=3).count() == 3 and desk.relevance().count() == 15
    desk.close()


@pytest.mark.parametrize("zeros", [0, 50, 95, 100])
def test_rank_bins_divide_equal_values_by_key(spark, zeros):
    rng = random.Random(zeros)
    rows = [(f"k{i:03d}", 0.0 if i < zeros else float(i)) for i in range(103)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, x double").repartition(3)
    found = {r["id"]: r["x_bin"] for r in rules.quantile_bins_fixed_labels(df, ["x"], "id").collect()}
    names = [f"x_{label}" for label in fixed.BIN_LABELS[5]]
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    expected = {r[0]: names[sum(at * 5 > 102 * i for i in range(1, 5))] for at, r in enumerate(ordered)}
    if zeros:
        assert found == expected
    assert set(found.values()) == set(names)


def test_correlations_with_and_without_nulls(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=200)
    data = np.column_stack([a, a + rng.normal(size=200), rng.normal(size=200)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in quality.correlation_matrix(df, ["a", "b", "c"]).collect()}
    expected = np.corrcoef(data.T)
    assert all(found[x, y] == pytest.approx(expected[i, j]) for i, x in enumerate("abc") for j, y in enumerate("abc"))
    holes = df.withColumn("b", F.when(F.col("c") < 1, F.col("b")))
    kept = data[data[:, 2] < 1]
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in quality.correlation_matrix(holes, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef(kept[:, 0], kept[:, 1])[0, 1])
    assert found["a", "c"] == pytest.approx(expected[0, 2]) and len(found) == 9


@pytest.mark.parametrize("decimals", [0, 1, 2, 3])
def test_fixed_point_texts_round_like_python(spark, decimals):
    rng = random.Random(decimals)
    numbers = [0.5, 1.5, 2.5, 56.25, 2.675, 1.005, 0.125, 0.375, 1e-9, 99.9999, 1234567.125, -3.25, -0.004, 0.0]
    numbers += [rng.randrange(10**6) / rng.choice([8, 16, 1000, 2000]) for _ in range(300)] + [rng.uniform(0, 1e6) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    found = column(df.select(text.format_rupiah(F.col("v"), decimals).alias("t")), "t")
    expected = ["Rp" + f"{v:,.{decimals}f}".translate(str.maketrans(",.", ".,")) for v in numbers]
    assert found == expected
