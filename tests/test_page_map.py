"""Deep pages by a map of the order, and pages that go on from the last row."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import explorer
from ledgerlens.operators.filters import Filters
from ledgerlens.operators.page_map import PageMap, next_page
from ledgerlens.session import cut_lineage


@pytest.fixture(scope="module")
def rows(spark):
    """Many ties, null amounts and null levels."""
    n = F.col("id")
    return cut_lineage(spark.range(2_500).select(
        F.format_string("TX%08d", (n * 7919) % 2500).alias("transaction_id"),
        F.when(n % 11 > 0, (n % 40).cast("double")).alias("amount"), (n % 6).cast("int").alias("risk_score"),
        F.when(n % 13 > 0, F.concat(F.lit("L"), n % 3)).alias("risk_level"), F.lit("iqr").alias("anomaly_reason"),
    ))


def ids(df):
    return [r["transaction_id"] for r in df.collect()]


@pytest.mark.parametrize("order", [("amount", "asc"), ("amount", "desc"), ("risk_score", "desc")])
def test_pages_equal_the_offset(spark, rows, tmp_path, order):
    pages = PageMap(spark, str(tmp_path), *order, rows_per_block=100)
    assert not pages.exists()
    assert pages.save(rows).exists()
    for page, size in ((1, 25), (3, 40), (84, 30), (100, 25), (101, 25)):
        assert ids(pages.page(rows, page, size)) == ids(explorer.search_transactions(rows, Filters(), *order, page, size))


def test_a_page_reads_its_blocks_only(spark, rows, tmp_path):
    pages = PageMap(spark, str(tmp_path), "amount", "asc", rows_per_block=100).save(rows)
    stored = spark.read.parquet(pages.path).inputFiles()
    read = pages.places(80, 30).inputFiles()
    assert read and {f.split("/")[-2] for f in read} == {"block=23"}
    assert len(read) < len(stored) / 5


def test_an_empty_table_has_empty_pages(spark, rows, tmp_path):
    pages = PageMap(spark, str(tmp_path), "amount", "asc").save(rows.filter("false"))
    assert ids(pages.page(rows, 1)) == []


@pytest.mark.parametrize("order", [("amount", "asc"), ("amount", "desc")])
def test_continued_pages_are_all_rows_in_order(rows, order):
    filters = Filters(risk_score_max=0)
    wanted = ids(explorer.search_transactions(rows, filters, *order, 1, 2_500))
    seen, after = [], None
    for _ in range(6):
        page = next_page(rows, filters, *order, after, 90).collect()
        seen += [r["transaction_id"] for r in page]
        after = (page[-1]["amount"], page[-1]["transaction_id"]) if page else after
    assert seen == wanted and len(seen) == 417


def test_a_continued_page_keeps_one_page_a_partition(rows, capsys):
    next_page(rows, Filters(), "amount", "asc", (5.0, "TX00000010")).explain("formatted")
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "Arguments: 25, " in plan
