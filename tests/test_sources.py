import glob
import os

import pytest
from pyspark.sql import functions as F, types as T

from conftest import at, tuples
from haulbook.plans.schemas import REPORTS, report_schema, store_report
from haulbook.sources import sinks, tables
from haulbook.sources.daytable import DayTable


def test_replace_window_twice_equals_once(frame):
    cols = "id int, d timestamp_ntz, v string"
    target = frame(cols, [(1, at("2017-03-01"), "old"), (2, at("2017-04-01"), "old"), (3, None, "old")])
    new = frame(cols, [(9, at("2017-03-05"), "new")])
    once = sinks.replace_window(target, new, "d", "2017-03-01", "2017-03-31")
    twice = sinks.replace_window(once, new, "d", "2017-03-01", "2017-03-31")
    assert tuples(once, "id", "v") == tuples(twice, "id", "v") == [(2, "old"), (3, "old"), (9, "new")]


def test_replace_partitions_keeps_other_days(frame, spark, tmp_path):
    out = str(tmp_path / "t")
    cols = "day string, v int"
    sinks.replace_partitions(frame(cols, [("2017-03-01", 1), ("2017-03-02", 2)]), out, "day")
    for _ in range(2):
        sinks.replace_partitions(frame(cols, [("2017-03-02", 5)]), out, "day")
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 5]


ROW = "id int, d timestamp_ntz, v string"


def day_rows(frame, *rows):
    return frame(ROW, [(i, d and at(d), v) for i, d, v in rows])


def test_day_table_replaces_a_window_and_drops_emptied_days(frame, spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "t"), "d")
    assert table.days() == []
    table.replace(day_rows(frame, (1, "2017-02-28 23:00:00", "a"), (2, "2017-03-01 01:00:00", "a"), (3, "2017-03-02", "a"), (4, "2017-03-03", "a"), (5, None, "a")))
    table.replace(day_rows(frame, (6, "2017-03-02 09:00:00", "b"), (7, "2017-03-02", "b")), "2017-03-01", "2017-03-02")
    assert tuples(table.read(), "id", "v") == [(1, "a"), (4, "a"), (5, "a"), (6, "b"), (7, "b")]
    assert table.days() == ["2017-02-28", "2017-03-02", "2017-03-03", "none"] and table.version() == 2
    assert tuples(table.read(1), "id") == [(i,) for i in range(1, 6)]
    assert table.remove_unlisted() == 1 and tuples(table.read(), "id") == [(1,), (4,), (5,), (6,), (7,)]
    table.replace(day_rows(frame), "2017-01-01", "2017-12-31")
    assert tuples(table.read(), "id") == [(5,)] and table.read().schema.simpleString() == "struct<id:int,d:timestamp_ntz,v:string>"
    table.replace(day_rows(frame))
    assert table.read().count() == 0


def test_day_table_refuses_and_stays_readable(frame, spark, tmp_path, monkeypatch):
    table = DayTable(spark, str(tmp_path / "t"), "d")
    table.replace(day_rows(frame, (1, "2017-03-01", "a")))
    new = day_rows(frame, (2, "2017-03-01", "b"))
    for bad, window in ((day_rows(frame, (2, "2017-03-05", "b")), ("2017-03-01", "2017-03-02")), (day_rows(frame, (2, None, "b")), ("2017-03-01", "2017-03-02"))):
        with pytest.raises(ValueError):
            table.replace(bad, *window)
    with pytest.raises(Exception):
        table.replace(new.drop("v").withColumn("w", F.lit(1)), "2017-03-01", "2017-03-01")
    # A run that breaks off before its manifest, and a second writer that is late.
    with monkeypatch.context() as m:
        m.setattr(DayTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.replace(new, "2017-03-01", "2017-03-01")
    assert tuples(table.read(), "id") == [(1,)]
    table.replace(new, "2017-03-01", "2017-03-01")
    with pytest.raises(Exception):
        table._commit(2, {"schema": {}, "days": {}})
    assert tuples(table.read(), "id") == [(2,)]


def test_day_table_evaluates_new_rows_once(frame, spark, tmp_path):
    """Replacing a table by rows read from itself is safe."""
    table = DayTable(spark, str(tmp_path / "t"), "d")
    table.replace(day_rows(frame, (1, "2017-03-01", "a"), (2, "2017-03-02", "a")))
    table.replace(table.read().withColumn("v", F.concat("v", F.lit("!"))), "2017-03-01", "2017-03-02")
    assert tuples(table.read(), "id", "v") == [(1, "a!"), (2, "a!")]


def test_write_report_conforms(frame, spark, tmp_path):
    schema = T.StructType.fromDDL("n decimal(9,2), s string")
    path = sinks.write_report(frame("s string, n int, extra int", [("a", 1, 2)]), str(tmp_path / "r"), schema)
    back = spark.read.parquet(path)
    assert back.schema.simpleString() == schema.simpleString() and back.count() == 1


def test_every_report_has_a_schema_that_is_enforced(frame, spark, tmp_path):
    assert len(REPORTS) >= 25 and all(len(report_schema(n).fields) == len(set(report_schema(n).names)) > 0 for n in REPORTS)
    rows = frame("order_count bigint, patient string, extra int", [(3, "A", 1), (None, None, 2)])
    back = spark.read.parquet(store_report(rows, "orders_by_patient", str(tmp_path / "r")))
    assert back.columns == ["patient", "order_count"] and tuples(back, "patient", "order_count") == sorted([("A", 3), (None, None)], key=str)
    with pytest.raises(ValueError, match="order_count"):
        store_report(rows.drop("order_count"), "orders_by_patient", str(tmp_path / "x"))
    with pytest.raises(Exception):
        store_report(rows.withColumn("order_count", F.lit("many")), "orders_by_patient", str(tmp_path / "y"))
    with pytest.raises(Exception):   # a value beyond its column
        store_report(frame("site_id bigint, site_name string, past_due bigint, tracked bigint, items bigint, pct_past_due double, pct_tracked double",
                           [(1, "s", 1, 1, 1, 1e9, 1.0)]), "inventory_past_due", str(tmp_path / "z"))


def test_exports(frame, spark, tmp_path):
    df = frame("site string, v string", [("a", " x "), ("a", "y"), ("b", "z")])
    path = sinks.export_delimited(df, str(tmp_path / "e"))
    assert any(open(f).read().startswith("site\tv\n") for f in glob.glob(path + "/*.csv"))
    assert tuples(spark.read.option("sep", "\t").option("header", True).csv(path), "site", "v") == [("a", "x"), ("a", "y"), ("b", "z")]
    path = sinks.export_by_key(df, str(tmp_path / "k"), "site")
    assert sorted(d for d in os.listdir(path) if d.startswith("site=")) == ["site=a", "site=b"]


def test_freshness(frame):
    o = frame("stamp timestamp_ntz", [(at("2017-03-01"),), (at("2017-03-05"),)])
    assert [tables.freshness_check(o, F.lit(d)).first().info for d in ("2017-03-05", "2017-03-06")] == ["DB OKAY", "WARNING UPDATE DATABASE"]


def test_constants_and_pair_labels(frame, spark):
    assert tables.state_regions(spark).count() == 51
    pairs = tables.item_pairs(spark)
    assert pairs.count() == pairs.distinct().count() == sum(map(len, tables.ITEM_PAIRS.values()))
    items = frame("item_id int, name string", [(9, " Bed "), (195, "Table")])
    small = tables.item_pairs(spark, {195: [9, 10]})
    assert tuples(tables.describe_pairs(small, items), "main_item", "description") == [(10, None), (9, "[ Table ] paired with [ Bed ]")]


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = sinks.shared_dir(spark)
    assert path != sinks.shared_dir(spark)
    assert root is None or path.startswith(root)
