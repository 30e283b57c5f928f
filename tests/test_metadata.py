"""Queries on variables tables: a field for each part, however many there are."""

import pytest
from pyspark.sql import functions as F

from strataframe.operators import schema as S
from strataframe.suite import registry
from strataframe.suite.shapes import TABLES

N = 1200


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """1,200 parts that share four sizes, each key's last digit and size many times."""
    registry.load_all()
    root = str(tmp_path_factory.mktemp("parts"))
    for t in TABLES:
        spark.range(1).write.parquet(f"{root}/{t}.parquet", mode="overwrite")
    rows = spark.range(1, N + 1).select(F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"), (F.col("id") % 4).cast("int").alias("p_size"))
    rows.repartition(3).write.parquet(f"{root}/part.parquet", mode="overwrite")
    return root


def ran(spark, parts, name):
    return registry.QUERIES[name](spark, parts)


def test_a_schema_has_every_field_of_its_table(spark, parts):
    got = ran(spark, parts, "schema_from_variables").orderBy("position").collect()
    keys = [k for k in range(1, N + 1) if k % 3 == 1 and k % 2 == 0]
    assert [(r.position, r.field) for r in got] == [(i, f"f_{k}") for i, k in enumerate(keys, 1)]
    assert {r.field: r.type for r in got}["f_10"] == "bigint" and {r.type for r in got} == {"string", "bigint"}


@pytest.mark.parametrize("table,package", [(None, None), ("b", "basic"), ("gone", None)])
def test_schema_rows_are_the_schema(spark, table, package):
    formats = ["", None, " yyyy-MM-dd ", "yyyy(round)", "yyyy-MM-dd'T'HH:mm'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "other"]
    kinds = ["real", "integer", " signed integer\t", "dateTime", "uri", None, "Real"]
    rows = [(t, f"{k}|{f}|{i % 2}", k, f, "basic" if i % 3 else "expanded", (i * 37) % 101) for t in ("a", "b") for i, (k, f) in enumerate((k, f) for k in kinds for f in formats)]
    v = spark.createDataFrame(rows, "`table` string, fieldName string, dataType string, pubFormat string, downloadPkg string, row_no int").repartition(5)
    schema = S.schema_from_variables(v.filter("table = 'b'") if table is None else v, table, package)
    frame = S.schema_from_variables(v.filter("table = 'b'") if table is None else v, table, package, collect=False)
    assert sorted(map(tuple, S.schema_table(frame).collect())) == ([] if schema is None else S.schema_table(schema))


def test_of_rows_that_repeat_a_field_the_first_counts(spark):
    rows = [("x", "real", 3), ("y", "string", 2), ("x", "integer", 1), ("x", "uri", 1 << 40)]
    v = spark.createDataFrame(rows, "fieldName string, dataType string, row_no long").withColumn("pubFormat", F.lit(None).cast("string"))
    assert [tuple(r) for r in S.schema_table(S.schema_from_variables(v, None, None, collect=False)).orderBy("position").collect()] == [(1, "x", "bigint"), (2, "y", "string")]
    assert [tuple(r) for r in S.schema_table(S.string_schema(v, collect=False)).orderBy("position").collect()] == [(1, "x", "string"), (2, "y", "string")]
    nameless = v.withColumn("fieldName", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="names no field"):
        S.string_schema(nameless, collect=False).collect()


def test_places_count_within_groups_over_all_tasks(spark):
    rows = [(g, k) for g, n in ((None, 300), ("a", 1000), ("b", 1)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(7)
    got = S.numbered(df, ["k"], "no", ["g"])
    assert dict(got.dtypes)["no"] == "int" and got.count() == len(rows) and got.filter("no <> k + 1").isEmpty()


def test_classes_of_every_field(spark, parts):
    got = ran(spark, parts, "field_classes").collect()
    assert {r.fieldName: r["class"] for r in got} == {f"f_{k}": "numeric" if k % 4 in (1, 2) else "character" for k in range(1, N + 1)}


@pytest.mark.parametrize("name,added", [("extend_variables", 2), ("extend_variables_positioned", 6)])
def test_extended_tables_keep_every_field_in_order(spark, parts, name, added):
    got = ran(spark, parts, name)
    assert got.count() == N + 3 * added
    before = added - 2
    own = got.filter("fieldName like 'f!_%' escape '!'").withColumn("k", F.substring("fieldName", 3, 9).cast("int"))
    assert own.count() == N and own.filter(F.col("row_no") != before + F.floor((F.col("k") + F.when(F.col("k") % 3 == 0, 0).otherwise(3 - F.col("k") % 3)) / 3)).isEmpty()


def test_patched_rows_of_every_part(spark, parts):
    got = sorted(r.fieldName for r in ran(spark, parts, "patch_variables").collect())
    assert got == sorted([f"f_{k}" for k in range(1, N + 1)] + [f"g_{k}" for k in range(1, N + 1) if k % 6 == 4])


def test_split_tables_count_every_field(spark, parts):
    assert {tuple(r) for r in ran(spark, parts, "split_by_table").collect()} == {(f"tab_{i}", N // 3) for i in range(3)}


def test_a_string_schema_has_every_field(spark, parts):
    got = ran(spark, parts, "string_schema").orderBy("position").collect()
    assert [tuple(r) for r in got] == [(k, f"f_{k}", "string") for k in range(1, N + 1)]
