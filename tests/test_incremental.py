"""Loads that take only what has changed."""

import os

import pytest

from cestero.sources.incremental import load_changes, manifest, read_loaded


@pytest.fixture
def shop(spark, tmp_path):
    """Writes receipt files, loads them, and tells what the table holds."""
    data, target = tmp_path / "data", str(tmp_path / "table")
    (data / "transactions").mkdir(parents=True)

    class Shop:
        folder = data / "transactions"

        def write(self, name, *lines):
            path = self.folder / f"{name}_Tran.csv"
            path.write_text("".join(f"{line}\n" for line in lines))
            return path

        def load(self, **settings):
            return load_changes(spark, str(data), target, **settings)

        def rows(self):
            found = read_loaded(spark, target).collect()
            rows = [(str(r.transaction_date), r.store_id, r.customer_id, r.products) for r in found]
            return sorted(rows, key=str)

        def versions(self, unit="store_id"):
            """Files of each unit's folder."""
            table = f"{target}/transactions"
            return {
                name: sorted(f for f in os.listdir(f"{table}/{name}") if f.endswith(".parquet"))
                for name in os.listdir(table)
                if name.startswith(unit)
            }

        def manifest(self):
            return manifest(spark, target)

    return Shop()


def test_new_and_changed_files_replace_their_stores_only(shop):
    shop.write(101, "2024-01-01|1|7|1 2", "2024-01-02|1|8|3")
    shop.write(102, "2024-01-01|2|7|4")
    assert shop.load() == shop_load(2, "1", "2")
    first = shop.versions()

    # The same files again: nothing is written.
    assert shop.load() == shop_load(0)
    assert shop.versions() == first

    shop.write(102, "2024-01-01|2|7|4 5", "2024-01-03|2|9|6")
    shop.write(103, "2024-01-04|3|9|7")
    assert shop.load() == shop_load(2, "2", "3")
    after = shop.versions()
    assert after["store_id=1"] == first["store_id=1"] and after["store_id=2"] != first["store_id=2"]
    assert shop.rows() == [
        ("2024-01-01", 1, 7, "1 2"), ("2024-01-01", 2, 7, "4 5"), ("2024-01-02", 1, 8, "3"),
        ("2024-01-03", 2, 9, "6"), ("2024-01-04", 3, 9, "7"),
    ]
    assert shop.load() == shop_load(0) and shop.versions() == after


def shop_load(files, *units):
    from cestero.sources.incremental import Load

    return Load(files, tuple(units))


def test_rows_of_other_files_in_a_replaced_unit_are_kept(shop):
    shop.write("a", "2024-01-01|1|1|1", "2024-01-01|2|1|2")
    shop.write("b", "2024-01-02|1|2|3", "2024-01-02|1|2|3")
    shop.load()
    shop.write("b", "2024-01-02|2|2|9")
    assert shop.load() == shop_load(1, "1", "2")
    assert shop.rows() == [("2024-01-01", 1, 1, "1"), ("2024-01-01", 2, 1, "2"), ("2024-01-02", 2, 2, "9")]


def test_a_unit_that_lost_all_rows_goes(shop):
    shop.write("a", "2024-01-01|1|1|1", "bad day|2|1|2", "2024-01-01||5|8")
    shop.write("b", "2024-01-01|3|1|3")
    assert shop.load() == shop_load(2, None, "1", "2", "3")
    assert ("None", 2, 1, "2") in shop.rows() and ("2024-01-01", None, 5, "8") in shop.rows()
    shop.write("a", "2024-01-01|1|1|1")
    assert shop.load() == shop_load(1, None, "1", "2")
    assert sorted(shop.versions()) == ["store_id=1", "store_id=3"]
    # What is empty is not listed, and so is as if gone.
    shop.write("a")
    assert shop.load() == shop_load(0)
    assert shop.load(drop_missing=True) == shop_load(1, "1")
    assert shop.rows() == [("2024-01-01", 3, 1, "3")]
    assert {(r.rows, r.unit) for r in shop.manifest().collect()} == {(0, None), (1, "3")}


def test_files_that_are_gone_keep_their_rows_unless_told_otherwise(shop):
    path = shop.write("a", "2024-01-01|1|1|1")
    shop.write("b", "2024-01-01|1|2|2", "2024-01-01|2|2|2")
    shop.load()
    path.unlink()
    assert shop.load() == shop_load(0) and len(shop.rows()) == 3
    assert shop.load(drop_missing=True) == shop_load(1, "1")
    assert shop.rows() == [("2024-01-01", 1, 2, "2"), ("2024-01-01", 2, 2, "2")]
    assert shop.load(drop_missing=True) == shop_load(0)
    # It may come back.
    shop.write("a", "2024-01-01|1|1|1")
    shop.load(drop_missing=True)
    assert len(shop.rows()) == 3


def test_by_day(shop):
    shop.write(101, "2024-01-01|1|7|1", "2024-01-02|1|8|3")
    shop.load(unit="transaction_date")
    first = shop.versions("transaction_date")
    shop.write(102, "2024-01-02|2|7|4", "2024-01-03|2|7|4")
    assert shop.load(unit="transaction_date") == shop_load(1, "2024-01-02", "2024-01-03")
    after = shop.versions("transaction_date")
    assert after["transaction_date=2024-01-01"] == first["transaction_date=2024-01-01"]
    assert len(shop.rows()) == 4
    with pytest.raises(ValueError):
        shop.load(unit="customer_id")


def test_a_load_that_failed_before_its_manifest_is_made_again(shop, monkeypatch):
    from cestero.sources import incremental

    shop.write(101, "2024-01-01|1|7|1")
    shop.load()
    shop.write(101, "2024-01-01|1|7|2", "2024-01-01|1|7|2")

    real = incremental.remove_folder
    shop.write(102, "2024-01-01|4|7|2")
    shop.load()
    shop.write(102, "2024-01-01|5|7|2")

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(incremental, "remove_folder", broken)
    with pytest.raises(OSError):
        shop.load()
    monkeypatch.setattr(incremental, "remove_folder", real)
    assert shop.load() == shop_load(1, "4", "5")
    assert shop.rows() == [("2024-01-01", 1, 7, "2"), ("2024-01-01", 1, 7, "2"), ("2024-01-01", 5, 7, "2")]
