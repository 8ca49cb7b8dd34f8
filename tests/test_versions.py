"""Versioned tables: what readers see when a step fails, schema changes, statistics, going back."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.plans import layers
from tallymart.sources import versions
from tallymart.sources.schemas import ADDED, DROPPED, INCOMPATIBLE, SAME, WIDENED, SchemaError, Shape, compare, shaped, widens
from tallymart.sources.tables import create_layer, list_tables
from tallymart.sources.versions import adopt, publish, published, read_version, rollback, write_version


class Killed(BaseException):
    """Not an Exception, so that no handler takes it for a failing file."""


@pytest.fixture(scope="module", autouse=True)
def layer(spark):
    create_layer(spark, "ver")


def ids(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


def test_readers_see_one_version_at_a_time(spark):
    first = write_version(spark.range(3), "ver.a")
    assert not spark.catalog.tableExists("ver.a") and published(spark, "ver.a") is None
    publish(spark, first)
    began = spark.table("ver.a")
    second = write_version(spark.range(5), "ver.a")
    assert ids(spark, "ver.a") == [0, 1, 2] and second.number == first.number + 1 == 2
    publish(spark, second)
    publish(spark, second)  # a repeated step changes nothing
    assert ids(spark, "ver.a") == [0, 1, 2, 3, 4] and began.count() == 3
    assert [r.tableName for r in list_tables(spark, "ver").collect() if r.tableName.startswith("a")] == ["a"]
    assert list_tables(spark, "ver", versions=True).count() > 2


STEPS = ["write_version", "grain_check", "publish", "_show", "drop"]


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", STEPS)
def test_killed_between_any_two_steps(spark, monkeypatch, step, when):
    name = f"ver.k_{step.strip('_')}_{when}"
    layers.write_verified(spark.range(2), name, "parquet")
    layers.write_verified(spark.range(3), name, "parquet")

    def killing(function):
        def run(*args, **kw):
            if when == "before":
                raise Killed
            function(*args, **kw)
            raise Killed

        return run

    if step == "drop":
        plain = type(spark).sql

        def sql(self, text, *args, **kw):
            if not text.startswith("DROP TABLE"):
                return plain(self, text, *args, **kw)
            if when == "after":
                plain(self, text, *args, **kw)
            raise Killed

        monkeypatch.setattr(type(spark), "sql", sql)
    else:
        owner = versions if step == "_show" else layers
        monkeypatch.setattr(owner, step, killing(getattr(owner, step)))
    with pytest.raises(Killed):
        layers.write_verified(spark.range(7), name, "parquet")
    monkeypatch.undo()
    shown = (step, when) in {("publish", "after"), ("_show", "after"), ("drop", "before"), ("drop", "after")}
    assert ids(spark, name) == list(range(7 if shown else 3))
    assert published(spark, name).statistics.rows == (7 if shown else 3)
    # the next run is not disturbed by what was left
    assert layers.write_verified(spark.range(4), name, "parquet").count() == 4
    assert ids(spark, name) == [0, 1, 2, 3]


def test_a_job_that_fails_half_way_leaves_the_table(spark):
    publish(spark, write_version(spark.range(3), "ver.h"))
    bad = spark.range(100, numPartitions=4).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        layers.write_verified(bad, "ver.h", "parquet")
    assert ids(spark, "ver.h") == [0, 1, 2]


def test_reading_goes_on_while_versions_change(spark):
    publish(spark, write_version(spark.range(10), "ver.r"))
    seen, wrong, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table("ver.r").count())
            except Exception as error:  # noqa: BLE001
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (20, 30, 40):
        publish(spark, write_version(spark.range(n), "ver.r"), keep=3)
    stop.set()
    reader.join()
    assert not wrong and seen <= {10, 20, 30, 40} and seen


def test_going_back(spark):
    for n in (1, 2, 3):
        publish(spark, write_version(spark.range(n), "ver.b"))
    assert len(versions.versions(spark, "ver.b")) == 2
    assert rollback(spark, "ver.b").count() == 2 and published(spark, "ver.b").statistics.rows == 2
    with pytest.raises(ValueError):
        rollback(spark, "ver.b")
    publish(spark, write_version(spark.range(9), "ver.b"))
    assert ids(spark, "ver.b") == list(range(9)) and rollback(spark, "ver.b").count() == 2


def test_plain_tables_are_adopted(spark):
    spark.range(4).write.saveAsTable("ver.p")
    with pytest.raises(versions.NotVersioned):
        publish(spark, write_version(spark.range(5), "ver.p"))
    assert spark.table("ver.p").count() == 4
    adopt(spark, "ver.p")
    assert published(spark, "ver.p").statistics.rows == 4
    publish(spark, write_version(spark.range(5), "ver.p"))
    assert ids(spark, "ver.p") == [0, 1, 2, 3, 4]


def test_statistics_are_those_of_the_version(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '2020-03-01 10:00:00', TIMESTAMP_NTZ '2020-01-02 03:04:05.123456',"
        " DATE '2020-02-02', true), (NULL, NULL, NULL, NULL, NULL), (3, TIMESTAMP '2019-01-01 00:00:00', NULL, NULL, true)"
        " AS t(`a b`, at, local, day, flag)"
    )
    version = write_version(df, "ver.s", flags=["flag"])
    publish(spark, version)
    s = published(spark, "ver.s").statistics
    assert s == version.statistics and s.rows == 3 and s.flags == {"flag": 2}
    assert s.nulls == {"a b": 1, "at": 1, "local": 2, "day": 2, "flag": 1}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for column in ("at", "local", "day"):
        got = spark.range(1).select(versions.from_held(s.greatest[column], kinds[column]).alias("v")).first().v
        assert got == df.agg(F.max(column)).first()[0], column
    empty = write_version(df.where("false"), "ver.s").statistics
    assert empty.rows == 0 and empty.greatest["at"] is None
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = spark.range(1).select(versions.from_held(s.greatest["at"], kinds["at"]).alias("v"))
        assert got.selectExpr("unix_micros(v)").first()[0] == int(s.greatest["at"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_three_versions_of_a_schema(spark):
    one = spark.sql("SELECT 1 AS id, CAST(2.5 AS FLOAT) AS price, 'x' AS note")
    two = spark.sql("SELECT 2L AS id, 3.5D AS price, 'y' AS note, 7 AS stock")
    three = spark.sql("SELECT 'z' AS place, 4.5D AS price, 3L AS id, 8L AS stock")
    stored = []
    for df in (one, two, three):
        version = write_version(df, "ver.e")
        publish(spark, version, keep=3)
        stored.append(version.stored)
    assert spark.table("ver.e").columns == ["place", "price", "id", "stock"]
    shape = Shape({"stock": 0, "place": "?"})
    union = [read_version(spark, "ver.e", s, shape) for s in stored]
    rows = [tuple(df.first()) for df in union]
    assert rows == [("?", 2.5, 1, 0), ("?", 3.5, 2, 7), ("z", 4.5, 3, 8)]
    assert all(df.schema.simpleString() == three.schema.simpleString() for df in union)
    assert read_version(spark, "ver.e", stored[0]).first().stock is None

    narrower = spark.sql("SELECT 'z' AS place, 'dear' AS price, 3L AS id, 8L AS stock")
    before = versions.versions(spark, "ver.e")
    with pytest.raises(SchemaError, match=r"incompatible price \(double -> string\)"):
        write_version(narrower, "ver.e")
    assert versions.versions(spark, "ver.e") == before and spark.table("ver.e").count() == 1
    publish(spark, write_version(narrower, "ver.e", replace_schema=True))
    assert spark.table("ver.e").first().price == "dear"
    with pytest.raises(SchemaError):
        read_version(spark, "ver.e", stored[2])


def test_kinds_of_change():
    def schema(text):
        return T._parse_datatype_string(text) if hasattr(T, "_parse_datatype_string") else T.StructType.fromDDL(text)

    old = schema("a int, b string, c decimal(9,2), d array<int>, e struct<x:int>, f float, gone int")
    new = schema("b string, a bigint, c decimal(12,3), d array<bigint>, e struct<x:int,y:int>, f string, more date")
    found = {c.column: c.kind for c in compare(old, new)}
    assert found == {
        "b": SAME, "a": WIDENED, "c": WIDENED, "d": WIDENED, "e": WIDENED,
        "f": INCOMPATIBLE, "more": ADDED, "gone": DROPPED,
    }
    assert {c.kind for c in compare(schema("a int"), schema("A int"))} == {INCOMPATIBLE}
    assert widens(T.IntegerType(), T.DoubleType()) and not widens(T.LongType(), T.DoubleType())
    assert widens(T.ShortType(), T.FloatType()) and not widens(T.IntegerType(), T.FloatType())
    assert widens(T.LongType(), T.DecimalType(19, 0)) and not widens(T.LongType(), T.DecimalType(19, 1))
    assert not widens(T.DecimalType(9, 2), T.DecimalType(9, 3)) and not widens(T.LongType(), T.IntegerType())


def test_shaped_rows(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    got = shaped(df, T.StructType.fromDDL("b string, c int, a bigint"), Shape({"c": 5}))
    assert tuple(got.first()) == ("x", 5, 1)
