"""Reports as they lie on disk, and the batch job."""

import json
from pathlib import Path

import pytest

from cestero.operators.quality import store_summary, write_per_store
from cestero.plans import job
from cestero.sinks.reports import Reports, json_records
from cestero.sinks.shared import shared_folder, stage_table


def documents(path):
    """All JSON lines of a folder written by Spark."""
    parts = sorted(Path(path).glob("part-*"))
    return [json.loads(line) for p in parts for line in p.read_text().splitlines()]


@pytest.fixture
def ranking(spark):
    rows = [(i, None if i == 2 else f"n{i}", 100 - i) for i in range(1, 31)]
    return spark.createDataFrame(rows, "id int, name string, n int").orderBy("id")


def test_records(ranking):
    left_out = [json.loads(r.value) for r in json_records(ranking, 2).collect()]
    assert left_out == [{"id": 1, "name": "n1", "n": 99}, {"id": 2, "n": 98}]
    kept = [json.loads(r.value) for r in json_records(ranking, 2, keep_nulls=True).collect()]
    assert kept[1] == {"id": 2, "name": None, "n": 98}


def test_top_items(ranking, tmp_path):
    path = Reports(str(tmp_path)).top_items(ranking, "things", 5)
    assert path.endswith("summary/top_5_things.json")
    [found] = documents(path)
    assert list(found) == ["type", "top_n", "data", "generated_at"]
    assert (found["type"], found["top_n"]) == ("things", 5)
    assert [row["id"] for row in found["data"]] == [1, 2, 3, 4, 5]
    assert found["data"][1] == {"id": 2, "name": None, "n": 98}


def test_series(ranking, tmp_path):
    reports = Reports(str(tmp_path))
    path = reports.time_series(ranking, "daily", "id", "n")
    assert len(documents(f"{path}/data")) == 30
    [manifest] = documents(f"{path}/manifest")
    assert manifest.pop("generated_at")
    assert manifest == {"series_name": "daily", "date_column": "id", "value_column": "n"}
    spread = reports.distribution(ranking, "sizes")
    assert spread.endswith("analytics/sizes_distribution.json")
    assert documents(f"{spread}/manifest")[0]["distribution_name"] == "sizes"
    cells = reports.matrix(ranking)
    assert documents(f"{cells}/manifest")[0]["matrix_name"] == "correlation_matrix"
    advice = reports.recommendations(ranking)
    assert advice.endswith("advanced/recommendations/product_associations.json")
    assert documents(f"{advice}/manifest")[0]["recommendation_type"] == "product_associations"


def test_clusters_show_every_assignment(spark, tmp_path):
    assignments = spark.range(1500).selectExpr("id AS customer_id", "id % 3 AS cluster")
    profiles = assignments.groupBy("cluster").count()
    members, summary = Reports(str(tmp_path)).clusters(assignments, profiles, 3)
    [found] = documents(f"{members}/manifest")
    assert (found["n_clusters"], found["total_customers"]) == (3, 1500)
    shown = {(r["customer_id"], r["cluster"]) for r in documents(f"{members}/data")}
    assert shown == {(k, k % 3) for k in range(1500)}
    assert len(documents(f"{summary}/data")) == 3


def test_metadata_keys_can_be_replaced(spark, tmp_path):
    info = {"status": "success", "task_id": "other"}
    [found] = documents(Reports(str(tmp_path)).run_metadata(spark, "dag", "task", info))
    assert (found["dag_id"], found["task_id"], found["status"]) == ("dag", "other", "success")
    assert found["execution_timestamp"]


def test_reports_are_replaced(spark, ranking, tmp_path):
    reports = Reports(str(tmp_path))
    for n in (3, 3):
        path = reports.top_items(ranking, "things", n)
    assert len(documents(path)) == 1


def test_staged_table_is_equal(spark, ranking):
    staged = stage_table(ranking)
    assert staged.schema == ranking.schema
    assert sorted(staged.collect()) == sorted(ranking.collect())
    assert shared_folder(spark) != shared_folder(spark)
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_csv_per_store(receipts, tmp_path):
    tx = receipts([("2024-01-01", s, 1, "1 2") for s in (1, 1, 2)])
    write_per_store(store_summary(tx), str(tmp_path / "stores"))
    folders = sorted(p.name for p in (tmp_path / "stores").iterdir() if p.is_dir())
    assert folders == ["store_id=1", "store_id=2"]


def test_job(spark, tmp_path):
    base, out = tmp_path / "in", tmp_path / "out"
    (base / "transactions").mkdir(parents=True)
    (base / "products").mkdir()
    lines = [f"2024-01-0{d}|1|{d}|{' '.join(str(p) for p in range(1, d + 1))}" for d in range(1, 8)]
    (base / "transactions/1_Tran.csv").write_text("\n".join(lines) + "\n")
    (base / "products/Categories.csv").write_text("1|A\n")
    (base / "products/ProductCategory.csv").write_text("p|c\n1|1\n2|1\n")
    args = job.parse_arguments(
        ["--data-base-uri", str(base), "--output-prefix", str(out), "--top-n", "3"]
    )
    source = job.DelimitedSource(spark, args.data_base_uri)
    job.run(source, args.output_prefix, args.top_n, args.dag_id, args.task_id)

    [metrics] = documents(out / "summary/basic_metrics.json")
    assert metrics == {"total_transactions": 7, "total_sales_units": 28}
    [products] = documents(out / "summary/top_3_products.json")
    sold = [(r["product_id"], r["total_sold"]) for r in products["data"]]
    assert sold == [(1, 7), (2, 6), (3, 5)]
    [categories] = documents(out / "summary/top_3_categories.json")
    assert categories["data"] == [
        {"category_id": None, "category_name": None, "total_volume": 15},
        {"category_id": 1, "category_name": "A", "total_volume": 13},
    ]
    assert len(documents(out / "summary/top_3_customers.json")[0]["data"]) == 3
    assert documents(out / "summary/top_3_peak_days.json")[0]["data"][0] == {
        "date": "2024-01-01", "num_transactions": 1,
    }
    [metadata] = documents(
        out / "metadata/01_executive_summary_generate_executive_summary.json"
    )
    assert metadata["total_transactions"] == 7
    assert metadata["total_sales_units"] == 28
    assert metadata["status"] == "success"


def test_sample_job(spark, tmp_path):
    (tmp_path / "transactions").mkdir()
    lines = [f"2024-01-{1 + i % 28:02d}|1|{i}|1 2" for i in range(100)]
    (tmp_path / "transactions/1_Tran.csv").write_text("\n".join(lines) + "\n")
    out = tmp_path / "out"
    job.run_sample(job.DelimitedSource(spark, str(tmp_path)), str(out), max_records=40)
    daily = documents(out / "analytics/sample_summary.json/data")
    assert sum(day["num_transacciones"] for day in daily) == 40
    [metadata] = documents(out / "metadata/02_sample_summary_sample.json")
    assert (metadata["total_transactions"], metadata["total_sales_units"]) == (40, 80)


@pytest.mark.parametrize("lines", [0, 60])
def test_totals_come_with_the_writes(spark, tmp_path, lines):
    """The summary took 21 jobs and the sample 10 when totals were queried for; also for no receipts."""
    base = tmp_path / "in"
    (base / "transactions").mkdir(parents=True)
    (base / "products").mkdir()
    text = "".join(f"2024-01-{1 + i % 28:02d}|1|{i}|1 2\n" for i in range(lines))
    (base / "transactions/1_Tran.csv").write_text(text)
    (base / "products/Categories.csv").write_text("1|A\n")
    (base / "products/ProductCategory.csv").write_text("p|c\n1|1\n2|1\n")
    source = job.DelimitedSource(spark, str(base))
    counts = {}
    for name, run in (("sample", job.run_sample), ("summary", job.run)):
        group = f"{name} {lines}"
        spark.sparkContext.setJobGroup(group, "")
        run(source, str(tmp_path / name))
        counts[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    [metadata] = documents(tmp_path / "summary/metadata/01_executive_summary_generate_executive_summary.json")
    [metrics] = documents(tmp_path / "summary/summary/basic_metrics.json")
    [sample] = documents(tmp_path / "sample/metadata/02_sample_summary_sample.json")
    totals = {"total_transactions": lines, "total_sales_units": 2 * lines}
    assert metrics == totals
    assert totals.items() <= metadata.items() and totals.items() <= sample.items()
    assert counts["sample"] < 10 and counts["summary"] < 21
