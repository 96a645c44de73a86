"""Readers, the choice of a source, bulk load."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cestero.sinks.delimited import write_delimited
from cestero.sources import DelimitedSource, JdbcSource, ingest, open_source
from cestero.sources.ingest import read_ingested, write_transactions
from cestero.sources.jdbc import Slices
from cestero.sources.select import settings_from


@pytest.fixture
def base(tmp_path):
    (tmp_path / "transactions").mkdir()
    (tmp_path / "products").mkdir()
    receipts = tmp_path / "transactions"
    (receipts / "1_Tran.csv").write_text("2024-01-01|1|10|1 2\n2024-01-02|1|11| 3 \n")
    (receipts / "2_Tran.csv").write_text("2024-01-03|2|x|4\nnever|2|12|\n")
    (receipts / "notes.txt").write_text("not a receipt\n")
    (tmp_path / "products/Categories.csv").write_text("1|FRUTA\n2|CARNES, AVES\n")
    (tmp_path / "products/ProductCategory.csv").write_text("product|category\n1|1\n2|2\n2|1\n")
    return str(tmp_path)


def test_receipts(spark, base):
    source = DelimitedSource(spark, base)
    found = {tuple(r) for r in source.transactions().collect()}
    assert found == {
        (date(2024, 1, 1), 1, 10, "1 2"),
        (date(2024, 1, 2), 1, 11, " 3 "),
        (date(2024, 1, 3), 2, None, "4"),
        (None, 2, 12, None),
    }
    assert [tuple(r) for r in source.stores().collect()] == [(1,), (2,)]
    assert source.transactions([2]).count() == 2
    assert source.transactions([]).count() == 0


def test_reference_data(spark, base):
    source = DelimitedSource(spark, base)
    assert [tuple(r) for r in source.categories().collect()] == [(1, "FRUTA"), (2, "CARNES, AVES")]
    assert [tuple(r) for r in source.product_categories().collect()] == [(1, 1), (2, 2), (2, 1)]
    assert source.product_categories().columns == ["product_id", "category_id"]


def test_paths_can_be_given_one_by_one(spark, base):
    source = DelimitedSource(spark, categories_path=f"{base}/products/Categories.csv")
    assert source.categories().count() == 2
    with pytest.raises(ValueError, match="base path"):
        source.transactions()


def test_other_separator(spark, tmp_path):
    (tmp_path / "c.csv").write_text("1;A\n")
    source = DelimitedSource(spark, categories_path=str(tmp_path / "c.csv"), sep=";")
    assert [tuple(r) for r in source.categories().collect()] == [(1, "A")]


def test_round_trip_keeps_spaces_but_reads_empty_as_null(spark, receipts, tmp_path):
    rows = [("2024-01-01", 1, 1, " 1  2 "), ("2024-01-01", 1, 2, ""), ("2024-01-01", 1, 3, None)]
    write_delimited(receipts(rows), f"{tmp_path}/transactions")
    back = DelimitedSource(spark, str(tmp_path)).transactions().collect()
    assert {r.customer_id: r.products for r in back} == {1: " 1  2 ", 2: None, 3: None}


def test_ingest_replaces_what_was_there(spark, base, tmp_path):
    target = str(tmp_path / "tables")
    for _ in range(2):
        paths = ingest(spark, base, target)
    assert read_ingested(spark, target).count() == 4
    one = read_ingested(spark, target).where("store_id = 1")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(store_id" in plan
    assert spark.read.parquet(paths["categories"]).count() == 2
    assert spark.read.parquet(paths["product_categories"]).count() == 3


def test_a_store_with_most_receipts_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "150KB")
    try:
        tx = spark.range(60_000, numPartitions=8).selectExpr(
            "date'2024-01-01' AS transaction_date",
            "cast(if(id % 3 = 0, id % 40, 1) AS int) AS store_id",
            "cast(id AS int) AS customer_id",
            "cast(hash(id) AS string) AS products",
        )
        write_transactions(tx, str(tmp_path / "t"))
    finally:
        spark.conf.unset(size)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("store_id=*")}
    assert len(files) == 40
    assert files["store_id=1"] > 2
    # Stores that share its shuffle partition are split along with it, others not.
    assert sum(n == 1 for n in files.values()) > 20
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


LOGIN = {"host": "db", "user": "reader", "password": "secret"}


def test_choice_of_source(spark, base):
    assert isinstance(open_source(spark, "S3", base=base), DelimitedSource)
    assert isinstance(open_source(spark, "Postgres", **LOGIN), JdbcSource)
    with pytest.raises(ValueError, match="unknown source"):
        open_source(spark, "ftp")
    with pytest.raises(ValueError, match="base path"):
        open_source(spark, "s3")
    with pytest.raises(ValueError, match="user and password"):
        open_source(spark, "postgres", host="db")


def test_settings_from_environment():
    assert settings_from({}) == {"kind": "postgres"}
    assert settings_from({"DATA_SOURCE": "postgres", "POSTGRES_HOST": "db"}) == {
        "kind": "postgres",
        "host": "db",
    }
    found = settings_from(
        {"DATA_SOURCE": "S3", "S3_DATA_BASE_URI": "s3a://in", "S3_FILE_SEPARATOR": ";"}
    )
    assert found == {"kind": "S3", "base": "s3a://in", "sep": ";"}


def test_jdbc_options(spark):
    cut = Slices("transaction_date", "2020-01-01", "2025-01-01", 64)
    source = JdbcSource(spark, **LOGIN, database="shop", slices={"transactions": cut})
    options = source.options("transactions")
    assert options["url"] == "jdbc:postgresql://db:5432/shop"
    assert options["partitionColumn"] == "transaction_date"
    assert (options["lowerBound"], options["upperBound"]) == ("2020-01-01", "2025-01-01")
    assert options["numPartitions"] == "64"
    assert "partitionColumn" not in source.options("categories")
    assert source.cut_of("transactions") == cut


def test_receipts_are_read_in_parallel(spark):
    with pytest.raises(ValueError, match="number of partitions"):
        JdbcSource(spark, **LOGIN).transactions()
    variables = {
        "POSTGRES_HOST": "db",
        "POSTGRES_USER": "reader",
        "POSTGRES_PASSWORD": "secret",
        "POSTGRES_PARTITION_COLUMN": "store_id",
        "POSTGRES_PARTITIONS": "32",
        "POSTGRES_PARTITION_LOWER": "1",
        "POSTGRES_PARTITION_UPPER": "900",
    }
    source = open_source(spark, **settings_from(variables))
    assert source.cut_of("transactions") == Slices("store_id", "1", "900", 32)
    options = source.options("transactions", source.cut_of("transactions"))
    assert (options["partitionColumn"], options["numPartitions"]) == ("store_id", "32")
    bounds = "(SELECT min(store_id) AS low, max(store_id) AS high FROM transactions) AS bounds"
    assert source.bounds_query("transactions") == bounds


def test_a_load_without_receipts_can_be_read(spark, receipts, tmp_path):
    dated = receipts([]).withColumn("transaction_date", F.col("transaction_date").cast("date"))
    write_transactions(dated, f"{tmp_path}/transactions")
    found = read_ingested(spark, str(tmp_path))
    assert found.columns == ["transaction_date", "store_id", "customer_id", "products"]
    assert found.count() == 0
