"""Tables that change together, and the enrichment run on top of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import table_sets
from ledgerloom.plans.enrichment_run import MERCHANTS, QUEUE, run_enrichment
from ledgerloom.plans.table_sets import Conflict, TableSet

AT, LATER = "2001-01-01 00:00:00", "2001-02-01 00:00:00"
MERCHANT = "merchant_id string, canonical_name string, category_id string, embedding array<float>, created_at timestamp_ntz, updated_at timestamp_ntz"
ITEM = "queue_id string, raw_description string, candidate_merchant_id string, distance double, created_at timestamp_ntz"
RULE = "rule_id string, category_id string, pattern string, priority int, line int"


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_tables_change_together_and_old_versions_stay(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    assert tables.version() == 0
    assert tables.replace({"a": numbers(spark, 1), "b": numbers(spark, 10)}) == 1
    assert tables.append({"a": numbers(spark, 2), "b": numbers(spark)}) == 2
    assert (ids(tables.read("a")), ids(tables.read("b"))) == ([1, 2], [10])
    assert ids(tables.read("a", 1)) == [1]
    tables.replace({"a": tables.read("a").where("id = 2")})
    assert (ids(tables.read("a")), ids(tables.read("b"))) == ([2], [10])


def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    tables.replace({"a": numbers(spark, 1)})
    tables.append({"a": numbers(spark, 2)}, expected=1)
    with pytest.raises(Conflict):
        tables.append({"a": numbers(spark, 3)}, expected=1)
    assert ids(tables.read("a")) == [1, 2]


def test_a_write_that_dies_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    tables = TableSet(spark, str(tmp_path / "set"))
    tables.replace({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    written = []

    def dies(df, path, partition_by=None):
        if written:
            raise RuntimeError("lost")
        written.append(path)
        df.write.parquet(path)

    monkeypatch.setattr(table_sets, "write_table", dies)
    with pytest.raises(RuntimeError):
        tables.append({"a": numbers(spark, 2), "b": numbers(spark, 2)})
    assert (tables.version(), ids(tables.read("a")), ids(tables.read("b"))) == (1, [1], [1])


def test_append_with_other_columns_is_refused(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    tables.replace({"a": numbers(spark, 1)})
    with pytest.raises(ValueError):
        tables.append({"a": spark.createDataFrame([("x",)], "other string")})


@pytest.fixture
def shop(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "shop"))
    tables.replace({
        MERCHANTS: spark.createDataFrame([("m1", "corner bakery", "dining", [1.0, 0.0], None, None),
                                          ("m2", "old hydro", "utilities", None, None, None),
                                          ("m3", None, "utilities", None, None, None)], MERCHANT),
        QUEUE: spark.createDataFrame([("q", "seen before", None, None, None)], ITEM)})
    return tables


def turned(cosine):
    return [cosine, float(np.sqrt(1 - cosine * cosine))]


DESCRIPTIONS = ["Corner Bakery #12345", "OLD HYDRO", "Fresh Fuel 99", "fresh fuel 99", "seen before", "", None, "12345 #77",
                "bakery on corner", "middling shop", "MIDDLING SHOP", "far shop", "Far Shop", "no vector yet", "no vector yet"]
VECTORS = [("bakery on corner", turned(0.9)), ("middling shop", turned(0.7)), ("far shop", turned(0.2)), ("far shop", turned(0.2)),
           ("unasked", turned(0.1)), (None, turned(0.1)), ("no vector yet", None)]


def run(spark, tables, descriptions=DESCRIPTIONS, vectors=VECTORS, at=AT):
    rules = spark.createDataFrame([("r2", "late", "fuel", 9, 1), ("r1", "fuel", "FUEL", 1, 2)], RULE)
    return run_enrichment(tables, spark.createDataFrame([(d, 1) for d in descriptions], "raw_description string, extra int"),
                          spark.createDataFrame(vectors, "canonical_name string, vec array<double>"), rules, at)


def test_run_appends_to_both_tables_and_a_rerun_adds_nothing(spark, shop):
    waiting = run(spark, shop)
    new = {r.canonical_name: (r.category_id, r.embedding is not None) for r in shop.read(MERCHANTS).where(
        f"created_at = timestamp_ntz '{AT}'").collect()}
    assert new == {"fresh fuel 99": ("fuel", False), "far shop": ("uncategorised", True)}
    queued = sorted((r.raw_description, r.candidate_merchant_id, round(r.distance, 3)) for r in shop.read(QUEUE).where(
        "distance is not null").collect())
    assert queued == [("MIDDLING SHOP", "m1", 0.3), ("middling shop", "m1", 0.3)]
    assert ids(waiting, "canonical_name") == ["no vector yet"]

    before = shop.read(MERCHANTS).count(), shop.read(QUEUE).count()
    run(spark, shop, at=LATER)
    assert (shop.read(MERCHANTS).count(), shop.read(QUEUE).count()) == before
    run(spark, shop, vectors=[*VECTORS, ("no vector yet", turned(-1.0))], at=LATER)
    assert ids(shop.read(MERCHANTS).where(f"created_at = timestamp_ntz '{LATER}'"), "canonical_name") == ["no vector yet"]


def test_run_over_empty_tables(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "none"))
    tables.replace({MERCHANTS: spark.createDataFrame([], MERCHANT), QUEUE: spark.createDataFrame([], ITEM)})
    assert run(spark, tables, [], []).count() == 0
    run(spark, tables, ["far shop"])
    assert ids(tables.read(MERCHANTS), "canonical_name") == ["far shop"]  # nothing to be near to


def test_run_that_meets_another_commit_starts_again(spark, shop, monkeypatch):
    append, calls = TableSet.append, []

    def beaten(self, tables, expected=None):
        calls.append(expected)
        if len(calls) == 1:  # another run adds the same name first
            append(self, {MERCHANTS: spark.createDataFrame([("x", "far shop", "dining", None, None, None)], MERCHANT)}, expected)
        return append(self, tables, expected)

    monkeypatch.setattr(TableSet, "append", beaten)
    run(spark, shop)
    assert calls == [1, 2]
    assert shop.read(MERCHANTS).where(F.col("canonical_name") == "far shop").count() == 1
