import math

import pytest
from pyspark.sql import functions as F

from strataframe.operators import spatial as G


def test_tile_cover_contains_own_tile(spark):
    pts = spark.createDataFrame([("p", 1000.0, 2999.9), ("q", 1500.0, 2500.0)], "id string, easting double, northing double")
    own = {(r["id"], r["tile_easting"], r["tile_northing"]) for r in G.assign_tiles(pts).collect()}
    cover = {(r["id"], r["tile_easting"], r["tile_northing"]) for r in G.assign_tiles(pts, buffer=700).collect()}
    assert own <= cover
    assert {c for c in cover if c[0] == "q"} == {("q", e, n) for e in (0, 1000, 2000) for n in (1000, 2000, 3000)}


def test_buffer_limit(spark):
    pts = spark.createDataFrame([("p", 1.0, 1.0)], "id string, easting double, northing double")
    with pytest.raises(ValueError):
        G.assign_tiles(pts, buffer=1000)


def test_utm_round_trip_and_known_point(spark):
    pts = spark.createDataFrame([("a", 40.0, -75.0, 18)], "id string, lat double, lon double, zone int")
    r = G.lonlat_to_utm(pts).collect()[0]
    assert abs(r["easting"] - 500000.0) < 1e-6
    # on the central meridian the northing is k0 times the meridian arc,
    # integrated here numerically as an independent check
    a, f = 6378137.0, 1 / 298.257223563
    e2, phi, n = f * (2 - f), math.radians(40.0), 20000
    arc = sum(a * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * phi / n) ** 2) ** 1.5 * (phi / n) for i in range(n))
    assert abs(r["northing"] - 0.9996 * arc) < 0.01
    back = G.reproject_utm(G.reproject_utm(G.lonlat_to_utm(pts), 18, 17)
                           .select("id", F.col("easting_out").alias("easting"), F.col("northing_out").alias("northing")),
                           17, 18).collect()[0]
    assert math.isclose(back["easting_out"], r["easting"], abs_tol=1e-3)
    assert math.isclose(back["northing_out"], r["northing"], abs_tol=1e-3)


def test_grid_mean_ignores_nan(spark):
    g = spark.createDataFrame([("S", "1", 0, 0, 1.0), ("S", "2", 0, 0, float("nan")), ("S", "3", 0, 0, 3.0)],
                              "site string, layer string, row int, col int, value double")
    out = G.grid_mean(g).filter("layer = 'S.summary'").collect()
    assert out[0]["value"] == 2.0
