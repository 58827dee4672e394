"""Search, paging and count queries."""

from pyspark.sql import functions as F

from ledgerlens.operators import explorer
from ledgerlens.operators.filters import Filters
from ledgerlens.operators.page_map import PageMap, next_page
from ledgerlens.operators.reason_index import ReasonIndex
from ledgerlens.plans.registry import STATEMENTS, cube, query, serving
from ledgerlens.plans.sql_views import CUBE, SERVING
from ledgerlens.session import cut_lineage, scratch_path

_COLUMNS = ", ".join(explorer.RESULT_COLUMNS)
_RISKY = Filters(risk_level=("Tinggi", "Kritis"), jenis_tujuan=("Nasabah",), status_kuras=("Terkuras Habis",))
_RISKY_SQL = "risk_level IN ('Tinggi', 'Kritis') AND jenis_tujuan = 'Nasabah' AND status_kuras = 'Terkuras Habis'"


@query("search_transactions", SERVING + f"SELECT {_COLUMNS} FROM serving ORDER BY risk_score DESC, transaction_id LIMIT 25")
def search_transactions(spark, folder):
    return explorer.search_transactions(serving(spark, folder))


@query("search_transactions_page_3", SERVING + f"SELECT {_COLUMNS} FROM serving WHERE {_RISKY_SQL} ORDER BY amount, transaction_id LIMIT 25 OFFSET 50")
def search_transactions_page_3(spark, folder):
    return explorer.search_transactions(serving(spark, folder), _RISKY, "amount", "asc", page=3)


@query("search_transactions_page_2000", SERVING + f"SELECT {_COLUMNS} FROM serving ORDER BY amount, transaction_id LIMIT 5 OFFSET 9995")
def search_transactions_page_2000(spark, folder):
    rows = cut_lineage(serving(spark, folder))
    return PageMap(spark, scratch_path(spark, "pages"), "amount", "asc").save(rows).page(rows, 2_000, 5)


@query("search_transactions_continued", STATEMENTS["search_transactions_page_3"])
def search_transactions_continued(spark, folder):
    """The third page, each page going on from the last row of the one before."""
    rows, after = cut_lineage(serving(spark, folder)), None
    for _ in range(2):
        last = next_page(rows, _RISKY, "amount", "asc", after).tail(1)
        after = (last[0]["amount"], last[0]["transaction_id"]) if last else after
    return next_page(rows, _RISKY, "amount", "asc", after)


def _register_search(name: str, text: str, where: str) -> None:
    @query(name, SERVING + f"SELECT transaction_id, risk_score, anomaly_reason FROM serving WHERE {where}")
    def search(spark, folder):
        return explorer.filter_rows(serving(spark, folder), Filters(search=text)).select("transaction_id", "risk_score", "anomaly_reason")


for _name, _text, _where in (
    ("search_mode", "saldo", "flag_BalanceMismatch"),
    ("search_mode_exact_id", "TX00000010", "transaction_id = 'TX00000010'"),
    ("search_mode_id_prefix", "TX0001", "transaction_id LIKE 'TX0001%'"),
    ("search_mode_short_prefix", "T0000", "transaction_id LIKE 'TX0000%'"),
    ("search_mode_method_word", " HDBSCAN ", "flag_HDBSCAN"),
    ("search_mode_free_text", "drained", "transaction_id ILIKE '%drained%' OR anomaly_reason ILIKE '%drained%'"),
):
    _register_search(_name, _text, _where)


@query(
    "search_mode_long_id",
    SERVING + "SELECT 'TX12' || substr(transaction_id, 3) AS transaction_id, risk_score FROM serving WHERE transaction_id = 'TX00000010'",
)
def search_mode_long_id(spark, folder):
    """Ids of ten digits: a search for one is exact, and its first eight digits alone find nothing else."""
    long_ids = F.concat(F.lit("TX12"), F.substring("transaction_id", 3, 100))
    rows = serving(spark, folder).withColumn("transaction_id", long_ids)
    return explorer.filter_rows(rows, Filters(search="tx1200000010")).select("transaction_id", "risk_score")


@query("capped_count", SERVING + "SELECT count(*) AS n FROM (SELECT 1 FROM serving WHERE anomaly_reason ILIKE '%balance mismatch%' LIMIT 50001)")
def capped_count(spark, folder):
    return explorer.capped_count(serving(spark, folder), Filters(search="balance mismatch"))


@query("count_routing", CUBE + f"SELECT sum(n)::BIGINT AS n, 'cube' AS source FROM cube WHERE {_RISKY_SQL}")
def count_routing(spark, folder):
    return explorer.count_routing(serving(spark, folder), cube(spark, folder), _RISKY)


@query("count_routing_exact_id", SERVING + "SELECT count(*) AS n, 'rows' AS source FROM serving WHERE transaction_id = 'TX00000010'")
def count_routing_exact_id(spark, folder):
    return explorer.count_routing(serving(spark, folder), cube(spark, folder), Filters(search="TX00000010"))


@query("count_routing_amount", SERVING + "SELECT count(*) AS n, 'capped' AS source FROM (SELECT 1 FROM serving WHERE amount >= 300000 LIMIT 50001)")
def count_routing_amount(spark, folder):
    return explorer.count_routing(serving(spark, folder), cube(spark, folder), Filters(amount_min=300_000))


@query(
    "token_search",
    SERVING
    + "SELECT transaction_id, anomaly_reason FROM serving WHERE list_has_any(string_split_regex(lower(anomaly_reason), '\\W+'), ['forest', 'drained']) "
    "OR transaction_id = 'Forest, drained'",
)


def token_search(spark, folder):
    return explorer.token_search(serving(spark, folder), "Forest, drained").select("transaction_id", "anomaly_reason")


@query("token_search_indexed", STATEMENTS["token_search"])
def token_search_indexed(spark, folder):
    index, rows = ReasonIndex.build(serving(spark, folder))
    return index.token_search(rows, "Forest, drained").select("transaction_id", "anomaly_reason")


@query("free_text_indexed", STATEMENTS["search_mode_free_text"])
def free_text_indexed(spark, folder):
    index, rows = ReasonIndex.build(serving(spark, folder))
    return index.free_text(rows, "drained").select("transaction_id", "risk_score", "anomaly_reason")


@query(
    "page_bounds",
    SERVING + "SELECT n, greatest(1, CAST(ceil(least(n, 50000) / 25) AS BIGINT)) AS max_page FROM (SELECT count(*) AS n FROM (SELECT 1 FROM serving WHERE flag_IsoForest LIMIT 50001))",
)


def page_bounds(spark, folder):
    return explorer.page_bounds(explorer.capped_count(serving(spark, folder), Filters(search="isolation")))
