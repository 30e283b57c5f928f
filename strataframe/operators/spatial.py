"""Spatial operators (G1-G9): map tiles for points, tile files, UTM
reprojection and footprint grids held in long form (layer, row, col, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import utm

TILE = 1000
# The site that straddles two UTM zones and the easting below
# which its points belong to the western zone.
TWO_ZONE_SITE = "BLAN"
TWO_ZONE_EASTING = 250000
GRID_HALF_CELLS = 150.5


def assign_tiles(points: DataFrame, buffer: float | None = None, *, x: str = "easting", y: str = "northing") -> DataFrame:
    """The lower-left corner of the 1 km tile of each point; with
    ``buffer``, every tile the square point ± buffer touches (distinct per
    point).  A buffer of 1000 m or more raises."""
    if buffer is None:
        return points.withColumn("tile_easting", (F.floor(F.col(x) / TILE) * TILE).cast("bigint")) \
                     .withColumn("tile_northing", (F.floor(F.col(y) / TILE) * TILE).cast("bigint"))
    if buffer >= TILE:
        raise ValueError("buffer must be below 1000 m")
    b = F.lit(float(buffer))
    xs = F.sequence(F.floor((F.col(x) - b) / TILE).cast("bigint"), F.floor((F.col(x) + b) / TILE).cast("bigint"))
    ys = F.sequence(F.floor((F.col(y) - b) / TILE).cast("bigint"), F.floor((F.col(y) + b) / TILE).cast("bigint"))
    out = (
        points.withColumn("_tx", F.explode(xs)).withColumn("_ty", F.explode(ys))
        .withColumn("tile_easting", F.col("_tx") * TILE).withColumn("tile_northing", F.col("_ty") * TILE)
        .drop("_tx", "_ty")
    )
    return out


def tile_file_coordinates(manifest: DataFrame, name_col: str = "name") -> DataFrame:
    """Tile corner numbers from names holding ``_<easting>_<northing>_``."""
    pat = r"_([0-9]{6,7})_([0-9]{7})_"
    e = F.regexp_extract(F.col(name_col), pat, 1)
    n = F.regexp_extract(F.col(name_col), pat, 2)
    return manifest.withColumn("tile_easting", F.nullif(e, F.lit("")).cast("bigint")) \
                   .withColumn("tile_northing", F.nullif(n, F.lit("")).cast("bigint"))


def match_tile_files(tiles: DataFrame, manifest: DataFrame, *, include_provisional: bool = False) -> tuple[DataFrame, DataFrame]:
    """(files of the requested tiles, requested tiles with no file).

    Tile numbers are pulled out of the names once and equi-joined — no
    substring nested loop.  Provisional files stay out unless asked."""
    files = tile_file_coordinates(manifest)
    if not include_provisional and "release" in files.columns:
        files = files.filter(F.col("release").isNull() | (F.col("release") != "PROVISIONAL"))
    keys = ["tile_easting", "tile_northing"]
    wanted = tiles.select(*keys).distinct()
    matched = files.join(wanted, keys, "left_semi")
    unmatched = wanted.join(files.select(*keys), keys, "left_anti")
    return matched, unmatched


def point_check(points: DataFrame, x: str = "easting", y: str = "northing") -> DataFrame:
    """G4 check row: points, non-numeric coordinates and one-sided pairs."""
    xv, yv = F.col(x).cast("string").try_cast("double"), F.col(y).cast("string").try_cast("double")
    return points.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"),
        F.count_if((F.col(x).isNotNull() & xv.isNull()) | (F.col(y).isNotNull() & yv.isNull())).cast("bigint").alias("n_non_numeric"),
        F.count_if(xv.isNull() != yv.isNull()).cast("bigint").alias("n_one_sided"),
        F.count_if(F.col(x).isNull() & F.col(y).isNull()).cast("bigint").alias("n_missing"),
    )


def valid_points(points: DataFrame, x: str = "easting", y: str = "northing") -> DataFrame:
    """Coordinates as doubles; raises on non-numeric, unpaired or missing
    values."""
    row = point_check(points, x, y).collect()[0]
    if row["n_non_numeric"] or row["n_one_sided"] or row["n_missing"]:
        raise ValueError("every point needs a numeric easting and northing")
    return points.withColumn(x, F.col(x).cast("double")).withColumn(y, F.col(y).cast("double"))


def reproject_utm(points: DataFrame, from_zone, to_zone, *, x: str = "easting", y: str = "northing") -> DataFrame:
    """UTM coordinates from one zone into another (zones may be columns
    or numbers), as codegen'd column maths."""
    return utm.reproject(points, from_zone, to_zone, x, y, "easting_out", "northing_out")


def site_zones(points: DataFrame, *, site: str = "siteID", zone: str = "zone", x: str = "easting") -> DataFrame:
    """G5 site rule: ``from_zone``/``to_zone`` per point.  At the two-zone
    site, points at or below easting 250000 are in the eastern zone (18) and
    go to the site's zone (17); elsewhere both are the point's zone."""
    east = (F.col(site) == TWO_ZONE_SITE) & (F.col(x) <= TWO_ZONE_EASTING)
    return points.withColumn("from_zone", F.when(east, F.col(zone) + 1).otherwise(F.col(zone))) \
                 .withColumn("to_zone", F.col(zone))


def lonlat_to_utm(points: DataFrame, *, lat: str = "lat", lon: str = "lon", zone: str = "zone") -> DataFrame:
    """Tower latitude/longitude to UTM easting/northing of its zone."""
    return utm.forward(points, F.col(lat), F.col(lon), F.col(zone), "easting", "northing")


def grid_mean(grid: DataFrame) -> DataFrame:
    """Per (site, row, col) the mean over layers ignoring null and NaN,
    as layer ``<site>.summary``, unioned before the layers.  A partial
    aggregate: one small shuffle whatever the number of layers."""
    mean = grid.groupBy("site", "row", "col").agg(F.avg(F.nanvl(F.col("value"), F.lit(None))).alias("value"))
    summary = mean.select("site", F.concat(F.col("site"), F.lit(".summary")).alias("layer"), "row", "col", "value")
    return summary.unionByName(grid.select("site", "layer", "row", "col", "value"))


def georeference_grid(grid: DataFrame, towers: DataFrame, reso: float, *, half_cells: float = GRID_HALF_CELLS) -> DataFrame:
    """Cell-centre x, y and EPSG code of each cell: the grid spans the
    tower position ± ``half_cells`` · ``reso``; rows run north to south.
    ``towers`` has one row per site (site, easting, northing, zone)."""
    t = towers.select("site", F.col("easting").alias("_te"), F.col("northing").alias("_tn"), F.col("zone").alias("_tz"))
    r = F.lit(float(reso))
    h = F.lit(float(half_cells))
    return (
        grid.join(t, "site", "left")
        .withColumn("x", F.col("_te") - h * r + (F.col("col") + 0.5) * r)
        .withColumn("y", F.col("_tn") + h * r - (F.col("row") + 0.5) * r)
        .withColumn("epsg", (F.lit(32600) + F.col("_tz")).cast("int"))
        .drop("_te", "_tn", "_tz")
    )


def grid_consistency(files: DataFrame) -> DataFrame:
    """G8 check row over per-file (site, reso, lat, lon, zone): counts of
    distinct resolutions, locations and sites, and the resolution to use
    (0 = unscaled when they differ)."""
    loc = F.struct("lat", "lon", "zone")
    return files.agg(
        F.count_distinct("reso").cast("bigint").alias("n_reso"),
        F.count_distinct(loc).cast("bigint").alias("n_locations"),
        F.count_distinct("site").cast("bigint").alias("n_sites"),
        F.when((F.count_distinct("reso") == 1) & (F.count_distinct(loc) == 1), F.max("reso")).otherwise(F.lit(0.0)).alias("reso_used"),
    )


def guard_one_site(files: DataFrame) -> DataFrame:
    """Raise when the grids are of several sites; returns the input."""
    if grid_consistency(files).first()["n_sites"] > 1:
        raise ValueError("the grids are of more than one site")
    return files


def transpose_grid(grid: DataFrame) -> DataFrame:
    """Swap rows and columns."""
    return grid.withColumnRenamed("row", "_r").withColumnRenamed("col", "row").withColumnRenamed("_r", "col")
