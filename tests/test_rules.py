import pytest
from pyspark.sql import functions as F

from strataframe.functions import names as N
from strataframe.functions import utm
from strataframe.operators import manifest as M
from strataframe.operators import schema as S
from strataframe.operators import series as E
from strataframe.operators import spatial as G
from strataframe.operators import stack as ST
from strataframe.plans import query as Q


def manifest_of(spark, paths):
    return M.parse_file_names(spark.createDataFrame([(p,) for p in paths], "path string"))


def test_an_unstamped_file_never_wins(spark):
    paths = ["r/NET.D01.ST00.DP1.00001.001.ord_x.csv", "r/NET.D01.ST00.DP1.00001.001.ord_x.20240101T000000Z.csv"]
    (row,) = M.latest_publication(manifest_of(spark, paths)).collect()
    assert row["path"] == paths[1] and row["latest_stamp"] == "20240101T000000Z"
    (row,) = M.latest_publication(manifest_of(spark, paths[:1])).collect()
    assert row["latest_stamp"] == M.UNDETERMINED


def test_averaging_is_the_whole_number(spark):
    names = ["a.ord_x_5min.csv", "a.ord_x_15min.csv", "a.ord_x_5_min.csv", "a.ord_mineral.csv", "a.readme.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert sorted(r.name for r in M.filter_time_index(df, 5).collect()) == sorted([names[0], *names[2:]])


def test_package_choice_with_null_keys(spark):
    rows = [("a", None, None, "basic"), ("b", None, None, "expanded"), ("c", "S", "m", "basic"), ("d", "T", "m", "other")]
    df = spark.createDataFrame(rows, "path string, site string, month string, package string")
    assert sorted(r.path for r in M.filter_package(df, "expanded").collect()) == ["b", "c", "d"]
    assert sorted(r.path for r in M.filter_package(df, "basic").collect()) == ["a", "c", "d"]


def test_positions(spark):
    df = spark.createDataFrame([("000", "010"), (None, None)], "hor string, ver string")
    assert M.filter_position(df, "000", "010").count() == 2
    with pytest.raises(ValueError, match="no file at position"):
        M.filter_position(df, "000", "020")
    with pytest.warns(UserWarning, match="no sensor positions"):
        assert M.filter_position(df.where("hor is null"), "000", "020").count() == 1


def test_release_and_long_table_names(spark):
    long = "x_" + "y" * 60
    df = spark.createDataFrame([(f"s/A.B.20240101T000000Z.RELEASE-2024/n.D01.{long}.csv",), ("s/plain/n.csv",)], "path string")
    got = df.select(N.release_of("path"), N.table_of(N.basename("path")), N.table_of(N.basename("path"), 50)).collect()
    assert [tuple(r) for r in got] == [("RELEASE-2024", long, None), (None, None, None)]


def test_one_name_in_two_releases_keeps_its_rows(spark):
    paths = [f"/s/A.20240101T000000Z.RELEASE-{y}/f.20240101T000000Z.csv" for y in (2023, 2024)]
    rows = spark.createDataFrame([(1, "file://" + paths[0]), (2, "file:" + paths[1])], "k int, file string")
    man = manifest_of(spark, paths + paths)
    got = sorted((r.k, r.release) for r in ST.with_provenance(rows, man).collect())
    assert got == [(1, "RELEASE-2023"), (2, "RELEASE-2024")]


def test_series_with_null_positions_and_equal_systems(spark):
    rows = [
        ("f", "/S/dp04/data/fluxCo2/nsae", "2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z", "flux", 1.0, 1),
        ("f", "/S/dp04/data/fluxCo2/turb", "2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z", "flux", 2.0, 2),
        ("f", "/S/dp04/data/fluxCo2/turb", "2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z", "flux", 3.0, 3),
    ]
    df = spark.createDataFrame(rows, "file string, dataset string, timeBgn string, timeEnd string, stat string, value double, o int")
    parsed = E.parse_series_time(E.parse_dataset_path(df))
    (wide,) = E.merge_series_wide(parsed, order_col="o").collect()
    assert (wide["data.fluxCo2.nsae.flux"], wide["data.fluxCo2.turb.flux"], wide["hor"]) == (1.0, 2.0, None)
    long = sorted((r.variable, r.value) for r in E.merge_series_wide(parsed, order_col="o", layout="long").collect())
    assert long == [("data.fluxCo2.nsae.flux", 1.0), ("data.fluxCo2.turb.flux", 2.0)]
    with pytest.raises(ValueError):
        E.merge_series_wide(parsed, order_col="o", layout="auto")
    with pytest.raises(Exception, match="no dataset matches"):
        E.filter_series(parsed, "dp01", var=["nothing"], avg=30).collect()


def test_sensor_tables_need_one_place(spark):
    man = manifest_of(spark, ["r/NET.D01.ST00.DP1.00001.001.000.010.030.ord_x_30min.2024-01.basic.20240101T000000Z.csv"])
    with pytest.raises(ValueError, match="one site and one position"):
        Q.dataset_query(spark, man, table="ord_x_30min")
    with pytest.raises(ValueError, match="not both"):
        Q.select_product_files(man, table="ord_x_30min", time_index=30)


def test_products_and_tables_that_are_not_queried(spark):
    def files(product, *tables):
        return manifest_of(spark, [f"r/NET.D01.ST00.{product}.{t}.2024-01.basic.20240101T000000Z.csv" for t in tables])

    with pytest.raises(ValueError, match="flux product"):
        Q.dataset_query(spark, files("DP4.00200.001", "ord_x"), table="ord_x")
    kinds = spark.createDataFrame([("DP3.30015.001", "AOP Data Product Type"), ("DP1.00001.001", "TIS Data Product Type")], "product string, kind string")
    with pytest.raises(ValueError, match="remote sensing"):
        Q.dataset_query(spark, files("DP3.30015.001", "ord_x"), table="ord_x", kinds=kinds)
    with pytest.raises(ValueError, match="one site and one position"):
        Q.dataset_query(spark, files("DP1.00001.001", "ord_x"), table="ord_x", kinds=kinds)
    both = files("DP1.00002.001", "ord_x").unionByName(files("DP1.00003.001", "ord_x"))
    with pytest.raises(ValueError, match="one product"):
        Q.dataset_query(spark, both, table="ord_x")
    # one file whose name holds two table parts, another that has the second only
    with pytest.raises(ValueError, match="more than one table"):
        Q.dataset_query(spark, files("DP1.00002.001", "ord_y.ord_x", "ord_x"), table="ord_x")
    assert Q.dataset_query(spark, files("DP1.00002.001", "ord_x"), table="ord_x", sites=["ZZ99"]) is None
    with pytest.warns(UserWarning, match="hor and ver are ignored"):
        assert Q.dataset_query(spark, files("DP1.00002.001", "ais_x"), table="ais_x", sites=["ZZ99"], hor="000") is None


def test_points_and_grids_that_raise(spark):
    schema = "easting string, northing string"
    for rows in ([("1", None)], [(None, None)], [("x", "1")]):
        with pytest.raises(ValueError):
            G.valid_points(spark.createDataFrame(rows, schema))
    assert G.valid_points(spark.createDataFrame([("1", "2.5")], schema)).count() == 1
    grids = spark.createDataFrame([("A", 1.0, 1.0, 1.0, 17), ("B", 1.0, 1.0, 1.0, 17)], "site string, reso double, lat double, lon double, zone int")
    with pytest.raises(ValueError, match="more than one site"):
        G.guard_one_site(grids)


# Published positions: latitude, longitude, zone, easting, northing.
PLACES = [(43.642567, -79.387139, 17, 630084.0, 4833438.0), (0.0, 3.0, 31, 500000.0, 0.0), (84.0, 0.0, 31, 465005.3, 9329005.2)]


@pytest.mark.parametrize("lat,lon,zone,easting,northing", PLACES)
def test_utm_of_published_positions(spark, lat, lon, zone, easting, northing):
    df = spark.createDataFrame([(lat, lon, zone)], "lat double, lon double, zone int")
    (r,) = G.lonlat_to_utm(df).collect()
    assert abs(r.easting - easting) < 1.0 and abs(r.northing - northing) < 1.0
    (b,) = utm.inverse(G.lonlat_to_utm(df), F.col("easting"), F.col("northing"), F.col("zone"), "la", "lo").collect()
    assert abs(b.la - lat) < 1e-8 and abs(b.lo - lon) < 1e-8


def test_utm_plan_stays_short(spark):
    df = spark.range(1).select((F.col("id") + 600000.0).alias("easting"), F.lit(4.8e6).alias("northing"))
    out = G.reproject_utm(df, 17, 18)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    (r,) = G.reproject_utm(out.select(F.col("easting_out").alias("easting"), F.col("northing_out").alias("northing")), 18, 17).collect()
    assert abs(r.easting_out - 600000.0) < 0.05 and abs(r.northing_out - 4.8e6) < 0.05


def test_trailing_junk_fails_a_strict_cast(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("d", T.DateType(), True, {"dataType": "dateTime", "pubFormat": "yyyy-MM-dd"})])
    with pytest.warns(UserWarning, match="kept as text"):
        out, ok = S.strict_cast_or_strings(spark.createDataFrame([("2024-01-01garbage",)], "d string"), schema)
    assert not ok and out.first().d == "2024-01-01garbage"


def test_shared_folder_is_asked_for_on_a_cluster():
    from strataframe import session

    class Context:
        master = "spark://x:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())


def test_the_buoy_product_moved_after_2024(spark):
    asked = spark.createDataFrame([("DP1.20046.001",), ("DP1.00001.001",)], "product string")
    none = spark.createDataFrame([], "product string, homeProduct string")
    for release, want in (("RELEASE-2024", "ok"), ("RELEASE-2025", "moved"), (None, "moved")):
        got = {r["product"]: r["status"] for r in M.resolve_bundles(asked, none, none, release).collect()}
        assert got == {"DP1.20046.001": want, "DP1.00001.001": "ok"}
