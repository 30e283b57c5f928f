"""Selections, packages, per-sample files, merges and sinks on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from strataframe.operators import manifest as M
from strataframe.operators import series as E
from strataframe.operators import stack as ST
from strataframe.plans import query as Q
from strataframe.plans import stack as P
from strataframe.sources.listing import scan_manifest

STAMP = "20240101T000000Z"
FOLDER = f"NET.D01.{{}}.DP1.00001.001.2024-01.expanded.{STAMP}.RELEASE-2024"
HEAD = "table,fieldName,description,dataType,units,downloadPkg,pubFormat,primaryKey,categoricalCodeName\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def manifest_of(spark, paths):
    files = spark.createDataFrame([(p, 1500000) for p in paths], "path string, size long")
    return M.parse_file_names(files)


@pytest.fixture
def request_files(spark):
    names = []
    for site in ("AAAA", "BBBB", "CCCC"):
        stem = f"NET.D01.{site}.DP1.00001.001"
        folder = f"r/{FOLDER.format(site).replace("expanded", "basic")}"
        names += [f"{folder}/{stem}.ord_x.2024-01.basic.{STAMP}.csv", f"{folder}/{stem}.variables.{STAMP}.csv", f"{folder}/{stem}.readme.{STAMP}.txt"]
        names += [f"{folder}/{stem}.sensor_positions.{STAMP}.csv"]
    names.append(f"r/NET.LAB1.DP1.00001.001.lab_y.{STAMP}.csv")
    return manifest_of(spark, names)


def test_a_request_names_redirects_roles_and_size(spark, request_files):
    lookup = spark.createDataFrame([("XXXX", "AAAA", "DP1.00001.001"), ("YYYY", "AAAA", "DP1.00002.001")], "site string, towerSite string, product string")
    bundles = spark.createDataFrame([("DP1.00009.001", "DP1.00008.001")], "product string, homeProduct string")
    got = Q.select_product_files(request_files, "DP1.00001.001", sites=["XXXX", "AAAA", "CCCC"], table="ord_x", shared_sites=lookup, chem_bundles=bundles).collect()
    assert {(r.site, r.requested_sites) for r in got} == {("AAAA", "AAAA,XXXX"), ("CCCC", "CCCC")}
    assert sorted(r.role for r in got) == ["data"] * 2 + ["readme"] + ["sensor_positions"] * 2 + ["variables"] * 2
    assert {(r.total_bytes, r.size_text, r.bundle_status) for r in got} == {(7 * 1500000, "10.5 MB", "ok")}


def test_requests_that_the_tables_rule_out_fail(spark, request_files):
    with pytest.raises(Exception, match="published by labs"):
        Q.select_product_files(request_files, "DP1.00001.001", table="lab_y").collect()
    for home, said in (("DP1.00008.001", "is bundled in DP1.00008.001"), ("depends", "several bundles")):
        bundles = spark.createDataFrame([("DP1.00001.001", home)], "product string, homeProduct string")
        with pytest.raises(Exception, match=said):
            Q.select_product_files(request_files, "DP1.00001.001", chem_bundles=bundles).select("path").collect()
    for product, said in (("DP1.00033.001", "hosted elsewhere"), ("DP1.00007.001", "only in the bundle")):
        with pytest.raises(ValueError, match=said):
            Q.select_product_files(request_files, product)
    with pytest.raises(ValueError, match="choose the basic"):
        Q.select_product_files(request_files, "DP1.10017.001", package="expanded")


def test_long_names_are_no_tables(spark):
    m = manifest_of(spark, [f"r/NET.D01.AAAA.DP1.00001.001.{'x_' * 30}.2024-01.basic.{STAMP}.csv"])
    assert m.first()["table"] is None


def store_with_packages(root):
    stem = "NET.D01.AAAA.DP1.00001.001"
    folder = f"{root}/{FOLDER.format('AAAA')}"
    fields = [("t_both", "k", "basic"), ("t_both", "v", "expanded"), ("t_basic", "k", "basic"), ("t_expanded", "k", "expanded"), ("t_absent", "k", "basic")]
    put(f"{folder}/{stem}.variables.{STAMP}.csv", HEAD + "".join(f"{t},{f},d,integer,,{p},integer,N,\n" for t, f, p in fields))
    put(f"{folder}/{stem}.t_both.2024-01.basic.{STAMP}.csv", "k\n1\n")
    put(f"{folder}/{stem}.t_both.2024-01.expanded.{STAMP}.csv", "k,v\n1,2\n")
    put(f"{folder}/{stem}.t_basic.2024-01.basic.{STAMP}.csv", "k\n3\n")
    put(f"{folder}/{stem}.t_expanded.2024-01.expanded.{STAMP}.csv", "k\n4\n")
    put(f"{folder}/{stem}.t_undeclared.2024-01.basic.{STAMP}.csv", "k\n5\n")


def test_the_variables_file_decides_a_package(spark, tmp_path):
    store_with_packages(tmp_path)
    for package, tables, columns in (("basic", {"t_both", "t_basic"}, {"k"}), ("expanded", {"t_both", "t_basic", "t_expanded"}, {"k", "v"})):
        with pytest.warns(UserWarning, match="t_absent"):
            out = P.stack_store(spark, str(tmp_path), package=package)
        assert {t for t in out if t.startswith("t_")} == tables
        assert [r[0] for r in out["missing_tables"].collect()] == ["t_absent"]
        assert columns == set(out["t_both"].columns) & {"k", "v"} and out["t_both"].count() == 1


def test_frame_rules_deal_files(spark, tmp_path):
    folder = f"{tmp_path}/NET.D01.AAAA.{{}}.2024-01.expanded.{STAMP}.RELEASE-2024"
    its = put(f"{folder.format('DP1.10081.001')}/s_ITS_1.csv", "k,abundance\n1,2\n")
    put(f"{folder.format('DP1.10081.001')}/s_16S_1.csv", "abundance,k\n2.5,1\n")
    put(f"{folder.format('DP1.10081.001')}/s_other_1.csv", "abundance,k\n2.5,1\n")
    put(f"{folder.format('DP1.20190.001')}/s_x_1.csv", "k\nwarm\n")
    put(f"{folder.format('DP1.00001.001')}/s_y_1.csv", "k\n1\n")
    man = scan_manifest(spark, str(tmp_path))
    dealt = {os.path.basename(r.path): r.output for r in P.frame_outputs(man, "NET.").collect()}
    assert dealt == {"s_ITS_1.csv": "mcc_soilPerSampleTaxonomy_ITS", "s_16S_1.csv": "mcc_soilPerSampleTaxonomy_16S", "s_x_1.csv": "rea_conductivityRawData"}
    rows = [("MCC", "k", "integer"), ("MCC", "abundance", "integer"), ("MCC2", "k", "integer"), ("MCC2", "abundance", "real"), ("REA", "k", "integer")]
    fields = spark.createDataFrame([(*r, "") for r in rows], "`table` string, fieldName string, dataType string, pubFormat string")
    with pytest.warns(UserWarning, match="types are inferred"):
        out = P.stack_frames(spark, man, fields, prefix="NET.")
    kinds = {t: dict(df.dtypes).get("abundance", dict(df.dtypes)["k"]) for t, df in out.items()}
    assert kinds == {"mcc_soilPerSampleTaxonomy_ITS": "bigint", "mcc_soilPerSampleTaxonomy_16S": "double", "rea_conductivityRawData": "string"}
    assert its


def test_a_failed_write_leaves_the_tables_before(spark, tmp_path):
    out = f"{tmp_path}/sink"
    assert ST.read_committed(spark, out) == {}
    a, b = spark.range(5).toDF("k"), spark.range(3).toDF("k")
    assert ST.write_committed({"a": a, "b": b}, out, "one") == 1
    failing = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        ST.write_committed({"a": b, "b": failing}, out, "two")
    assert {t: df.count() for t, df in ST.read_committed(spark, out).items()} == {"a": 5, "b": 3}
    assert ST.write_committed({"a": b}, out, "two", max_rows=1) == 2
    assert ST.write_committed({"a": a}, out, "two") == 2  # a replay
    last = ST.read_committed(spark, out)
    assert list(last) == ["a"] and last["a"].count() == 3 and len(last["a"].inputFiles()) >= 3
    assert ST.read_committed(spark, out, 1)["a"].count() == 5


def test_order_is_proved_from_bounds(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 501).alias("site"), "id")
    path = ST.write_sorted(df, ["site"], f"{tmp_path}/sorted", max_rows=300)
    proof = ST.order_faults(spark, path, ["site"]).first()
    assert proof["n_rows"] == 5000 and proof["n_faults"] == 0 and proof["n_files"] >= 5000 // 300
    df.repartition(3).write.parquet(f"{tmp_path}/unsorted")
    assert ST.order_faults(spark, f"{tmp_path}/unsorted", ["site"]).first()["n_faults"] > 1000


def series(spark, rows):
    df = spark.createDataFrame(rows, "file string, dataset string, timeBgn string, timeEnd string, stat string, value double, o int")
    return E.parse_series_time(E.parse_dataset_path(df))


def test_a_merge_is_hash_aggregates_and_one_shuffle(spark):
    rows = [(f"f{i % 2}", f"/S/dp01/data/s/000_010_30m/v{i % 5}", f"2024-01-01T{i % 24:02d}:00:00Z", f"2024-01-01T{i % 24:02d}:30:00Z", "m", float(i), i) for i in range(200)]
    wide = E.merge_series_wide(series(spark, rows), order_col="o")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="whole numbers"):
        E.merge_series_wide(series(spark, rows), order_col="stat")
    assert E.merge_series_wide(series(spark, rows), order_col="o", columns=["no.such.one.m"]).filter("`no.such.one.m` IS NULL").count() == wide.count()


def test_the_cadence_is_that_of_the_first_rows(spark):
    def rows(file, first, rest):
        for i in range(60):
            seconds = first if i < 20 else rest
            name = ("isoCo2/000_010_09m/dlta13CCo2", "isoH2o/000_010_09m/dlta18OH2o")[i % 2]
            yield (file, f"/S/dp01/data/{name}", f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00:00Z", f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:{seconds // 60:02d}:00Z", "m", 1.0, i)

    fast = series(spark, [*rows("late", 540, 360)])  # all rows: 420 s on average
    got = {r.file: r.mean_interval for r in E.isotope_cadence_files(fast).collect()}
    assert got == {"late": 540.0} and not E.isotope_cadence_check(fast).first()["flag"]
    both = series(spark, [*rows("late", 540, 360), *rows("early", 360, 540)])
    assert E.isotope_cadence_check(both).first()["flag"] and not E.isotope_cadence_check(both, 30).first()["flag"]


def test_attributes_of_every_kind(spark):
    files = spark.createDataFrame([("a.2024-01.basic.h5", "S1"), ("b.2024-01-05.expanded.h5", "S2"), ("c.2024-02.basic.h5", "S1")], "file string, site string")
    levels = [("a.2024-01.basic.h5", "S1", {"x": ["1", "2"], "site": ["q"]}), ("a.2024-01.basic.h5", "/", {"v": ["9"]}),
              ("b.2024-01-05.expanded.h5", "S2", {"y": []}), ("b.2024-01-05.expanded.h5", "/S2/dp01/data/rtioMoleDryCo2Vali", {"c": ["3"]})]
    attrs = spark.createDataFrame(levels, "file string, level string, attrs map<string, array<string>>")
    site = {r.date: r for r in E.file_attributes(files, attrs, "site").collect()}
    assert site["2024-01"].x == "1,2" and site["2024-01"]["_site"] == "q" and site["2024-01"].y is None
    assert site["2024-01-05"].y == "" and (site["2024-02"].site, site["2024-02"].x) == ("S1", None)
    assert sorted((r.date, r.v) for r in E.file_attributes(files, attrs, "root").collect()) == [("2024-01", "9"), ("2024-01-05", None), ("2024-02", None)]
    assert {r.date: r.c for r in E.file_attributes(files, attrs, "val").collect()} == {"2024-01": None, "2024-01-05": "3", "2024-02": None}
    with pytest.raises(ValueError):
        E.file_attributes(files, attrs, "other")


def test_only_variables_of_stacked_tables_are_extended(spark):
    variables = spark.createDataFrame([("a", "k", 0), ("b", "k", 1), ("c", "k", 2)], "`table` string, fieldName string, row_no long")
    added = spark.createDataFrame([("horizontalPosition",), ("release",)], "fieldName string")
    man = manifest_of(spark, [f"r/NET.D01.AAAA.DP1.00001.001.sensor_positions.{STAMP}.csv"])
    extra = spark.createDataFrame([("sensor_positions", "x"), ("science_review_flags", "y")], "`table` string, fieldName string")
    out = P.complete_variables(variables, {"a": ["horizontalPosition", "k"], "b": ["k"]}, man, added, extra)
    got = sorted((r["table"], r["fieldName"]) for r in out.collect())
    assert got == [("a", "horizontalPosition"), ("a", "k"), ("a", "release"), ("b", "k"), ("b", "release"), ("c", "k"), ("sensor_positions", "x")]


def test_a_folder_without_scheme_is_qualified(spark, tmp_path):
    from strataframe.session import qualified

    assert qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert qualified(spark, "hdfs://n/x") == "hdfs://n/x"


def test_a_request_goes_over_the_manifest_once(spark, request_files, tmp_path):
    rows = request_files.select("path", "size").collect()
    spark.createDataFrame(rows, "path string, size long").write.parquet(f"{tmp_path}/listing")
    man = M.parse_file_names(spark.read.parquet(f"{tmp_path}/listing"))
    got = Q.select_product_files(man, "DP1.00001.001", sites=["AAAA", "CCCC"], table="ord_x")
    assert not any("/listing/" in f for f in got.inputFiles())
    assert sorted(r.role for r in got.collect()) == ["data"] * 2 + ["readme"] + ["sensor_positions"] * 2 + ["variables"] * 2
    everything = Q.select_product_files(man)
    assert not any("/listing/" in f for f in everything.inputFiles()) and everything.count() == len(rows)


def test_a_file_longer_than_a_task_is_written_in_order(spark, tmp_path, monkeypatch):
    from strataframe.suite import product_store as PS

    monkeypatch.setattr(PS, "TASK_LINES", 50)
    lines = spark.range(2000).select((F.col("id") % 2).cast("string").alias("key"), (F.col("id") * 7919 % 2000).alias("no"))
    lines = lines.unionByName(spark.createDataFrame([("0", None), ("1", -1)], "key string, no long")).withColumn("line", F.concat_ws(":", "key", F.coalesce(F.col("no").cast("string"), F.lit("last"))))
    files = spark.createDataFrame([(k, f"file://{tmp_path}/out/{k}/f.csv") for k in "01"], "key string, path string")
    PS.write_lines(lines.repartition(3), files, f"file://{tmp_path}/staged", lines.count())
    assert len([f for f in os.listdir(f"{tmp_path}/staged/key=0") if f.startswith("part-")]) > 4
    for key, own in (("0", [*range(0, 2000, 2), "last"]), ("1", [-1, *range(1, 2000, 2)])):
        with open(f"{tmp_path}/out/{key}/f.csv") as f:
            assert f.read() == "".join(f"{key}:{n}\n" for n in own)


def test_a_task_reads_few_rows_of_a_large_row_group(spark, tmp_path, monkeypatch):
    from strataframe.suite import product_store as PS
    from strataframe.suite.shapes import TABLES, register_tables

    for t in TABLES:
        spark.range(1).write.parquet(f"{tmp_path}/{t}.parquet", mode="overwrite")
    day = F.date_add(F.lit("1993-01-01").cast("date"), (F.col("id") % 3000).cast("int")).cast("timestamp_ntz")
    orders = spark.range(3000).select(F.col("id").alias("o_orderkey"), (F.col("id") * 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), day.alias("o_orderdate"))
    orders.unionByName(orders.limit(5)).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet", mode="overwrite")
    monkeypatch.setattr(PS, "FILE_ROWS", 50)
    register_tables(spark, str(tmp_path))
    rows = PS.staged_rows(spark)
    assert sorted(rows.collect()) == sorted(spark.sql(PS.ROWS_SQL).collect())
    assert rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 32 * 50
    root = PS.write_product_store(spark, str(tmp_path))
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{root}/main").filter(F.col("_metadata.file_name").contains(".prd_basic.") & (F.col("value") != "k"))
    assert lines.count() == 3005 and lines.distinct().count() == 3000
