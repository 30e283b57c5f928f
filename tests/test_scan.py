import os
import subprocess
import sys

import pytest

from strataframe.plans import query as Q
from strataframe.plans.stack import load_table, stack_store
from strataframe.sources import csv as C
from strataframe.sources.listing import scan_manifest

PREFIX = "NET.D01.ST00.DP1.00001.001"
VARIABLES = (
    "table,fieldName,description,dataType,units,downloadPkg,pubFormat,primaryKey,categoricalCodeName\n"
    "ord_a,key,k,integer,,basic,integer,Y,\nord_a,price,p,real,,basic,*.##,N,\nord_a,note,n,string,,expanded,asIs,N,\n"
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    return str(path)


def files_of(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_columns_follow_file_order_and_names(spark, tmp_path):
    a = put(f"{tmp_path}/1.csv", "siteID,zz\ns1,1\n")
    b = put(f"{tmp_path}/2.csv", 'aa,siteID\n"x, ""y""\nz",s2\nNA,s3\n')
    empty = put(f"{tmp_path}/0.csv", "")
    files = files_of(spark, [b, a, empty, a])
    assert C.superset_header(spark, files) == ["siteID", "zz", "aa"]
    rows = sorted(tuple(r)[:3] for r in C.scan_csv(spark, files).collect())
    assert rows == [("s1", "1", None), ("s2", None, 'x, "y"\nz'), ("s3", None, None)]
    assert C.scan_csv(spark, files_of(spark, [empty])) is None


@pytest.mark.parametrize("bad", [b"a,b\n1,2,3\n", b"a,b\n\xff\xfe,1\n", b"\xff\xfe\n1\n", None])
def test_unreadable_files_fail_with_their_path(spark, tmp_path, bad):
    good = put(f"{tmp_path}/good.csv", "a,b\n1,2\n")
    path = f"{tmp_path}/bad.csv" if bad is None else put(f"{tmp_path}/bad.csv", bad)
    with pytest.raises(Exception, match="bad.csv"):
        C.scan_csv(spark, files_of(spark, [good, path])).collect()


def test_inferred_types(spark, tmp_path):
    a = put(f"{tmp_path}/a.csv", "i,d,t,s\n1,1.5,2024-01-01T00:00:00,x\n")
    b = put(f"{tmp_path}/b.csv", "s,i,d,t\n7,2,3,2024-01-02T00:00:00\n")
    out = C.scan_csv_inferred(spark, files_of(spark, [a, b]))
    assert [f.dataType.simpleString() for f in out.schema.fields][:4] == ["bigint", "double", "timestamp", "string"]


@pytest.fixture
def both_packages(tmp_path):
    """One site-month in both packages under one stamp, another in basic only,
    a third provisional."""
    for month, package, price, release in (
        ("2024-01", "basic", 1, "RELEASE-2024"), ("2024-01", "expanded", 2, "RELEASE-2024"),
        ("2024-02", "basic", 3, "RELEASE-2024"), ("2024-03", "basic", 4, "PROVISIONAL"),
    ):
        stamp = "20240601T000000Z"
        folder = f"{tmp_path}/{PREFIX}.{month}.{package}.{stamp}.{release}"
        put(f"{folder}/{PREFIX}.ord_a.{month}.{package}.{stamp}.csv", f"key,price,note\n{month[-1]},{price},n\n")
        put(f"{folder}/{PREFIX}.variables.{stamp}.csv", VARIABLES)
    return str(tmp_path)


@pytest.mark.parametrize("package,want", [("basic", [(1, 1.0), (2, 3.0)]), ("expanded", [(1, 2.0), (2, 3.0)])])
def test_one_package_counts_and_provisional_stays_out(spark, both_packages, package, want):
    df = stack_store(spark, both_packages, package=package)["ord_a"]
    assert sorted((r["key"], r["price"]) for r in df.collect()) == want
    assert ("note" in df.columns) == (package == "expanded")
    df = load_table(spark, both_packages, "ord_a", package=package)
    assert sorted((r["key"], r["price"]) for r in df.collect()) == want
    more = load_table(spark, both_packages, "ord_a", package=package, include_provisional=True)
    assert more.count() == 3


def test_no_variables_file_old_enough(spark, both_packages):
    with pytest.raises(ValueError, match="as old as"):
        stack_store(spark, both_packages, pubdate="2024-05-01")


def test_workers_started_elsewhere_can_import_the_package(tmp_path):
    path = put(f"{tmp_path}/a.csv", "x\n1\n")
    code = (
        f"import sys; sys.path.insert(0, {os.getcwd()!r})\n"
        "from strataframe.session import build_session\nfrom strataframe.sources import csv as C\n"
        "s = build_session('local[1]')\n"
        f"print('rows', C.scan_csv(s, s.createDataFrame([({path!r},)], 'path string')).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


def store_of_versions(root, versions):
    """One file and one variables file for each (variables text, price cell, time cell)."""
    for k, (said, price, time) in enumerate(versions):
        stamp, month = f"202406{k % 28 + 1:02d}T00{k // 28:02d}00Z", f"2024-{k % 12 + 1:02d}"
        folder = f"{root}/{PREFIX}.{month}.basic.{stamp}.RELEASE-2024"
        put(f"{folder}/{PREFIX}.ord_a.{month}.basic.{stamp}.csv", f"key,price,note,at\n{k},{price},n,{time}\n")
        put(f"{folder}/{PREFIX}.variables.{stamp}.csv", said)


def test_versions_are_told_apart_by_content(spark, tmp_path):
    """Four publications, two variables versions: the field that they type
    differently becomes text."""
    from strataframe.plans import stack as P

    other = VARIABLES.replace("price,p,real", "price,p,string")
    store_of_versions(tmp_path, [(VARIABLES if k != 2 else other, f"{k}.50", "") for k in range(4)])
    man = scan_manifest(spark, str(tmp_path))
    assert P.version_digests(spark, man).select("version").distinct().count() == 2
    out = P.stack_versions(spark, man, "ord_a")
    assert sorted((r.key, r.price) for r in out.select("key", "price").collect()) == [(k, f"{k}.50") for k in range(4)]


def test_three_versions_with_formats_types_and_lacking_fields(spark, tmp_path):
    from strataframe.plans import stack as P

    at = "ord_a,at,t,dateTime,,basic,{},N,\n"
    second, minute = at.format("yyyy-MM-dd'T'HH:mm:ss'Z'"), at.format("yyyy-MM-dd'T'HH:mm'Z'(floor)")
    store_of_versions(tmp_path, [
        (VARIABLES + second, "1.50", "2024-01-01T10:20:30Z"),
        (VARIABLES.replace("real", "string") + minute, "2.50", "2024-01-01T10:20Z"),
        (VARIABLES, "3.50", "not declared"),
    ])
    out = P.stack_versions(spark, scan_manifest(spark, str(tmp_path)), "ord_a")
    assert dict(out.dtypes)["at"] == "timestamp" and dict(out.dtypes)["price"] == "string"
    got = sorted((r.key, r.price, r.at and r.at.strftime("%H:%M:%S")) for r in out.collect())
    assert got == [(0, "1.50", "10:20:30"), (1, "2.50", "10:20:00"), (2, "3.50", None)]
    with pytest.warns(UserWarning, match="kept as text"):
        expanded = P.stack_versions(spark, scan_manifest(spark, str(tmp_path)), "ord_a", package="expanded")
    assert sorted(r.at for r in expanded.select("at").collect()) == ["2024-01-01T10:20:30Z", "2024-01-01T10:20Z", "not declared"]


def test_fifty_versions_are_one_scan(spark, tmp_path, monkeypatch):
    from strataframe.plans import stack as P

    scans, own = [], C.scan_csv
    monkeypatch.setattr(C, "scan_csv", lambda *a, **b: scans.append(own(*a, **b)) or scans[-1])
    store_of_versions(tmp_path, [(VARIABLES + f"ord_a,f{k},x,real,,basic,*,N,\n", f"{k}.5", "") for k in range(50)])
    out = P.stack_versions(spark, scan_manifest(spark, str(tmp_path)), "ord_a")
    assert sorted(r.price for r in out.select("price").collect()) == [k + 0.5 for k in range(50)]
    assert len(scans) == 2  # the data files and the variables files
    assert scans[0]._jdf.queryExecution().analyzed().toString().count("Relation [") == 1


def leaves(df):
    """The file scans of an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_a_query_opens_matching_files_and_columns_only(spark, both_packages):
    man = scan_manifest(spark, both_packages)
    df = Q.dataset_query(spark, man, table="ord_a", package="basic")
    everything = leaves(df)
    assert sum(x.metrics().apply("numFiles").value() for x in everything) == 2
    one = df.filter("month = '2024-02' AND price = '3'").select("key")
    (scan,) = leaves(one)
    assert scan.metrics().apply("numFiles").value() == 1
    said = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(price,3)" in said and "ReadSchema: struct<key:string,price:string>" in said
    assert [r.key for r in one.collect()] == ["2"]
    assert sum(x.metrics().apply("numFiles").value() for x in leaves(df.filter("siteID = 'ST99'"))) == 0


def test_large_files_are_split_where_lines_are_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "SPLIT_BYTES", 1000)
    whole = put(f"{tmp_path}/whole.csv", "k,v\n" + "".join(f'{i},"a, ""{i}"""\n' for i in range(2000)))
    broken = put(f"{tmp_path}/broken.csv", "k,v\n" + "".join(f'{i},"b\n{i}"\n' for i in range(2000, 2100)))
    small = put(f"{tmp_path}/small.csv", 'k,v\n9999,"c\nd"\n')
    assert C.whole_line_files(spark, [whole, broken]) == {whole}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = C.scan_csv(spark, files_of(spark, [whole, broken, small]))
        assert df.rdd.getNumPartitions() > 4
        rows = {int(r.k): r.v for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {i: f'a, "{i}"' for i in range(2000)} | {i: f"b\n{i}" for i in range(2000, 2100)} | {9999: "c\nd"}
    assert rows == want


def test_a_strict_table_is_parsed_once(spark, both_packages, monkeypatch):
    from strataframe.plans import stack as P

    scans, own = [], C.scan_csv
    monkeypatch.setattr(C, "scan_csv", lambda *a, **b: scans.append(1) or own(*a, **b))
    man = scan_manifest(spark, both_packages).filter("package = 'basic' AND month IS NOT NULL")
    variables = P.read_variables(spark, scan_manifest(spark, both_packages))
    out = P.stack_table(spark, man, "ord_a", variables=variables)
    assert len(scans) == 1 and out.inputFiles() and all(f.endswith(".parquet") for f in out.inputFiles())
    lazy = P.stack_table(spark, man, "ord_a", variables=variables, strict=False)
    assert all(f.endswith(".csv") for f in lazy.inputFiles())
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, lazy.collect()))


def test_repeated_names_in_a_header(spark, tmp_path):
    df = C.scan_csv(spark, files_of(spark, [put(f"{tmp_path}/r.csv", "a,b,a\n1,2,3\n")]))
    assert [tuple(r)[:2] for r in df.collect()] == [("3", "2")]
