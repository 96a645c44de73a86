"""Rejected rows of delimited files."""

from datetime import date

import pytest

from cestero.sources import DelimitedSource, ingest
from cestero.sources.checked import Checked, accepted, rejected
from cestero.sources.ingest import read_ingested, read_quarantine


@pytest.fixture
def base(tmp_path):
    (tmp_path / "transactions").mkdir()
    (tmp_path / "products").mkdir()
    receipts = tmp_path / "transactions"
    (receipts / "1_Tran.csv").write_text("2024-01-01|1|10|1 2\n2024-01-02|1|11| 3 \n2024-01-02|||\n|1|12|4\n")
    (receipts / "2_Tran.csv").write_text(
        "2024-01-03|2|x|4\nnever|2|12|\n2024-01-03|2\n2024-01-03|2|13|5|6\n"
        "2024-01-03|two|y|4\n2024-01-03|99999999999|13|5\n2024-01-04|2|14|7\n"
    )
    (tmp_path / "products/Categories.csv").write_text("1|FRUTA\n2|CARNES, AVES\nthree|PAN\n")
    (tmp_path / "products/ProductCategory.csv").write_text("product|category\n1|1\n2|2\n2|1\n")
    return tmp_path


def test_good_rows_are_those_of_the_plain_reader(spark, base):
    source = DelimitedSource(spark, str(base))
    kept = accepted(Checked(source).transactions())
    assert kept.columns == source.transactions().columns
    assert kept.schema == source.transactions().schema
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        (date(2024, 1, 1), 1, 10, "1 2"), (date(2024, 1, 2), 1, 11, " 3 "),
        (date(2024, 1, 2), None, None, None), (None, 1, 12, "4"), (date(2024, 1, 4), 2, 14, "7"),
    ]))
    assert source.transactions().count() == 11


def test_rejected_rows_have_reason_line_and_file(spark, base):
    rows = rejected(Checked(DelimitedSource(spark, str(base))).transactions()).collect()
    assert {r.file.rsplit("/", 1)[1] for r in rows} == {"2_Tran.csv"}
    assert sorted((r.line, r.reason) for r in rows) == [
        ("2024-01-03|2", "columns"),
        ("2024-01-03|2|13|5|6", "columns"),
        ("2024-01-03|2|x|4", "customer_id"),
        ("2024-01-03|99999999999|13|5", "store_id"),
        ("2024-01-03|two|y|4", "store_id"),
        ("never|2|12|", "transaction_date"),
    ]


def test_a_load_with_quarantine(spark, base, tmp_path):
    target = str(tmp_path / "tables")
    ingest(spark, str(base), target, quarantine=True)
    assert read_ingested(spark, target).count() == 5
    found = read_quarantine(spark, target).collect()
    assert len(found) == 7
    assert [(r.line, r.reason) for r in found if r.input == "categories"] == [("three|PAN", "category_id")]

    # Mended files leave nothing behind; without quarantine, bad cells are NULL as ever.
    (base / "transactions/2_Tran.csv").write_text("2024-01-04|2|14|7\n")
    (base / "products/Categories.csv").write_text("1|FRUTA\n")
    ingest(spark, str(base), target, quarantine=True)
    assert read_quarantine(spark, target).isEmpty() and read_ingested(spark, target).count() == 5


def test_good_files_are_read_once(spark, base, tmp_path):
    """Without rejected rows there is one job of each table, its write."""
    (base / "transactions/2_Tran.csv").unlink()
    (base / "products/Categories.csv").write_text("1|FRUTA\n")
    spark.sparkContext.setJobGroup("quarantine", "")
    try:
        ingest(spark, str(base), str(tmp_path / "tables"), quarantine=True)
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup("quarantine")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The write of receipts has a stage before its exchange, which is a job of its own.
    assert len(jobs) <= 4
