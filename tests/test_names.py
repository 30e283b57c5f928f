from strataframe.operators import manifest as M

PATHS = [
    "root/OBS.D01.HARV.DP1.00001.001.2019-01.basic.20240115T101010Z.RELEASE-2024/"
    "OBS.D01.HARV.DP1.00001.001.000.010.030.2DWSD_30min.2019-01.basic.20240115T101010Z.csv",
    "root/OBS.D01.HARV.DP1.00001.001.2019-01.basic.20240115T101010Z.RELEASE-2024/"
    "OBS.D01.HARV.DP1.00001.001.ltr_pertrap.basic.20240115T101010Z.csv",
    "root/x/OBS.Lab1.DP1.00001.001.lig_externalSummary_pub.20230101T000000Z.csv",
    "root/OBS.D02.AB12.DP1.00001.001.2019-02.expanded.20250101T000000Z.PROVISIONAL/"
    "OBS.D02.AB12.DP1.00001.001.sensor_positions.20250101T000000Z.csv",
]


def manifest(spark):
    return M.parse_file_names(spark.createDataFrame([(p,) for p in PATHS], "path string"))


def test_parse_identity(spark):
    by_table = {r["table"]: r for r in manifest(spark).collect()}
    r = by_table["2DWSD_30min"]
    assert (r["domain"], r["site"], r["hor"], r["ver"], r["time_index"]) == ("D01", "HARV", "000", "010", "030")
    assert r["table_type"] == "site-date"
    assert r["month"] == "2019-01" and r["package"] == "basic"
    assert r["publication"] == "20240115T101010Z" and r["release"] == "RELEASE-2024"
    assert by_table["ltr_pertrap"]["table_type"] == "site-all"
    lab = by_table["lig_externalSummary"]
    assert lab["table_type"] == "lab" and lab["lab"] == "Lab1" and lab["site"] is None
    sp = by_table["sensor_positions"]
    assert sp["table_type"] == "site-all" and sp["site"] == "AB12" and sp["release"] == "PROVISIONAL"


def test_conflicting_types_raise(spark):
    import pytest

    paths = ["a/OBS.D01.HARV.DP1.00001.001.tab_x.2019-01.basic.20240101T000000Z.csv",
             "a/OBS.D01.HARV.DP1.00001.001.tab_x.basic.20240101T000000Z.csv"]
    m = M.parse_file_names(spark.createDataFrame([(p,) for p in paths], "path string"))
    with pytest.raises(ValueError):
        M.table_types(m)


def test_latest_is_subset_one_per_key(spark):
    paths = [f"a/OBS.D01.HARV.DP1.00001.001.tab_x.basic.2024010{d}T000000Z.csv" for d in (1, 3, 2)]
    m = M.parse_file_names(spark.createDataFrame([(p,) for p in paths], "path string"))
    out = M.select_files_by_type(m).collect()
    assert len(out) == 1 and out[0]["publication"] == "20240103T000000Z"


def test_release_rules(spark):
    import pytest

    m = manifest(spark)
    with pytest.raises(ValueError):
        M.filter_release(m, "PROVISIONAL", include_provisional=False)
    assert M.filter_release(m, "current").filter("release = 'PROVISIONAL'").count() == 0


def test_dated_files_all_count_even_with_one_path(spark):
    rows = [("s/a.csv", "a.csv", "t", "site-date", "S1", None)] * 2 + [
        ("s/t2.20240101T000000Z.csv", "t2.20240101T000000Z.csv", "t2", "site-all", "S1", None),
        ("s/t2.20250101T000000Z.csv", "t2.20250101T000000Z.csv", "t2", "site-all", "S1", None),
        ("s/l.20250101T000000Z.csv", "l.20250101T000000Z.csv", "l", "lab", None, "L1"),
        ("s/none.csv", "none.csv", None, None, None, None),
    ]
    m = spark.createDataFrame(rows, "path string, name string, table string, table_type string, site string, lab string")
    kept = sorted(r["path"] for r in M.select_files_by_type(m).collect())
    assert kept == ["s/a.csv", "s/a.csv", "s/l.20250101T000000Z.csv", "s/t2.20250101T000000Z.csv"]
