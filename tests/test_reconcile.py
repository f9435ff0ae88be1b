import pytest
from pyspark.sql import functions as F, types as T

from cinestrata.sources import reconcile


def write(spark, path, day, columns):
    spark.range(4).select(*[F.expr(e).alias(n) for n, e in columns.items()]).coalesce(1).write.parquet(
        f"{path}/day={day}")


def test_three_types_read_as_one(spark, root):
    write(spark, root, 1, {"id": "cast(id as int)", "v": "cast(id as int)", "t": "'x'"})
    write(spark, root, 2, {"id": "cast(id as int)", "v": "id + 5000000000", "t": "'x'"})
    write(spark, root, 3, {"id": "id", "v": "id + 0.5D", "u": "date'2020-01-01'"})
    write(spark, root, 4, {"id": "id", "v": "id + 0.5D", "u": "timestamp'2020-01-02 03:00:00'"})
    df = reconcile.read_reconciled(spark, root)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "id": "bigint", "v": "double", "t": "string", "u": "timestamp", "day": "int"}
    rows = df.orderBy("day", "id").collect()
    assert len(rows) == 16 and [r["v"] for r in rows[:9]] == [
        0.0, 1.0, 2.0, 3.0, 5e9, 5e9 + 1, 5e9 + 2, 5e9 + 3, 0.5]
    assert rows[0]["t"] == "x" and rows[0]["u"] is None and rows[8]["t"] is None
    runs = reconcile.schema_runs(spark, root)
    assert [len(files) for files, _ in runs] == [1, 1, 1, 1]


def test_runs_follow_the_changes(spark, root):
    for day in range(10, 17):
        write(spark, root, day, {"v": "cast(id as int)"} if day < 13 else {"v": "id"})
    runs = reconcile.schema_runs(spark, root)
    assert [(len(f), s["v"].dataType) for f, s in runs] == [(3, T.IntegerType()), (4, T.LongType())]
    df = reconcile.read_reconciled(spark, root).where("day = 11 and v > 2")
    assert df.count() == 1


def test_catalog_table_is_widened(spark, root):
    write(spark, root, 1, {"v": "cast(id as int)", "w": "cast(id as int)"})
    name = "widened_" + root[-8:].replace("-", "_")
    reconcile.reconcile_table(spark, "default", name, root, ("day",))
    write(spark, root, 2, {"v": "id + 5000000000", "w": "id + 0.25D", "x": "'new'"})
    assert reconcile.reconcile_table(spark, "default", name, root, ("day",)) == ["v", "w", "x"]
    got = spark.sql(f"select sum(v) v, sum(w) w, count(x) x, count(*) n from default.{name}").first()
    assert tuple(got) == (20000000000 + 12, 13.0, 4, 8)
    write(spark, root, 3, {"v": "id + 0.5D"})
    with pytest.raises(ValueError, match="long"):
        reconcile.reconcile_table(spark, "default", name, root, ("day",))
    spark.sql(f"drop table default.{name}")


def test_types_without_a_common_one(spark, root):
    write(spark, root, 1, {"v": "id"})
    write(spark, root, 2, {"v": "'text'"})
    with pytest.raises(ValueError, match="column v"):
        reconcile.read_reconciled(spark, root)
