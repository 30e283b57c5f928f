from strataframe.operators.stack import dedupe_latest_by_id

ROWS = [
    ("a", "2024-01-01", "x"), ("a", "2024-01-01", "x"),   # exact duplicate
    ("a", "2024-02-01", "newer"),                         # newer version wins
    ("b", "2024-01-01", "t1"), ("b", "2024-01-01", "t2"), # tie
    ("c", None, "n1"), ("c", "2024-01-01", "n2"),         # null stamp keeps all
    (None, "2024-01-01", "noid"),                          # null id kept
]


def frame(spark):
    return spark.createDataFrame(ROWS, "srfID string, lastUpdateDateTime string, note string")


def test_latest_per_id(spark):
    out = sorted((r["srfID"] or "", r["note"]) for r in dedupe_latest_by_id(frame(spark), tiebreak=["note"]).collect())
    assert out == [("", "noid"), ("a", "newer"), ("b", "t1"), ("c", "n1"), ("c", "n2")]


def test_keep_ties(spark):
    out = sorted((r["srfID"] or "", r["note"]) for r in dedupe_latest_by_id(frame(spark), keep_ties=True).collect())
    assert ("b", "t1") in out and ("b", "t2") in out and ("a", "x") not in out
