"""Catalogue operators (C25-C31): nested JSON product catalogues flattened
with ``from_json`` and ``explode`` (schema declared, no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SITE = T.StructType([
    T.StructField("siteCode", T.StringType()),
    T.StructField("availableMonths", T.ArrayType(T.StringType())),
    T.StructField("availableDataUrls", T.ArrayType(T.StringType())),
])
FILE = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("md5", T.StringType()), T.StructField("size", T.LongType()),
])
PACKAGE = T.StructType([
    T.StructField("package", T.StringType()), T.StructField("siteCode", T.StringType()),
    T.StructField("month", T.StringType()), T.StructField("files", T.ArrayType(FILE)),
])
RELEASE = T.StructType([T.StructField("release", T.StringType()), T.StructField("packages", T.ArrayType(PACKAGE))])
CHANGE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("parentIssueID", T.LongType()),
    T.StructField("issueDate", T.StringType()), T.StructField("resolvedDate", T.StringType()),
    T.StructField("dateRangeStart", T.StringType()), T.StructField("dateRangeEnd", T.StringType()),
    T.StructField("locationAffected", T.StringType()), T.StructField("issue", T.StringType()),
    T.StructField("resolution", T.StringType()),
])
SENSOR = T.StructType([T.StructField("name", T.StringType()), T.StructField("sensor", T.StringType())])
PRODUCT = T.StructType([T.StructField("data", T.StructType([
    T.StructField("productCode", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("siteCodes", T.ArrayType(SITE)),
    T.StructField("changeLogs", T.ArrayType(CHANGE)),
    T.StructField("releases", T.ArrayType(RELEASE)),
    T.StructField("productSensors", T.ArrayType(SENSOR)),
]))])


def parse_products(df: DataFrame, col: str = "json") -> DataFrame:
    """One parsed ``data`` struct per product document."""
    return df.select(F.from_json(F.col(col), PRODUCT).getField("data").alias("d"))


def explode_availability(df: DataFrame, col: str = "json") -> DataFrame:
    """(product, site, month, url) of every available site-month."""
    p = parse_products(df, col)
    sites = p.select(F.col("d.productCode").alias("product"), F.explode("d.siteCodes").alias("s"))
    pairs = sites.select("product", F.col("s.siteCode").alias("site"),
                         F.explode(F.arrays_zip(F.col("s.availableMonths").alias("m"),
                                                F.col("s.availableDataUrls").alias("u"))).alias("z"))
    return pairs.select("product", "site", F.col("z.m").alias("month"), F.col("z.u").alias("url"))


def explode_files(df: DataFrame, col: str = "json") -> DataFrame:
    """Release -> package of a site-month -> file rows (product, release,
    package, site, month, name, url, md5, size); site and month are null where
    the document gives packages without them."""
    p = parse_products(df, col)
    r = p.select(F.col("d.productCode").alias("product"), F.explode("d.releases").alias("r"))
    k = r.select("product", F.col("r.release").alias("release"), F.explode("r.packages").alias("k"))
    f = k.select("product", "release", F.col("k.package").alias("package"), F.col("k.siteCode").alias("site"),
                 F.col("k.month").alias("month"), F.explode("k.files").alias("f"))
    return f.select("product", "release", "package", "site", "month", "f.name", "f.url", "f.md5", "f.size")


def product_sensors(df: DataFrame, col: str = "json") -> DataFrame:
    """(product, name, sensor)."""
    p = parse_products(df, col)
    s = p.select(F.col("d.productCode").alias("product"), F.explode("d.productSensors").alias("s"))
    return s.select("product", "s.name", "s.sensor")


def issue_log(df: DataFrame, col: str = "json", bundles: DataFrame | None = None) -> DataFrame:
    """The change log rows of each product (products without a log give
    no rows).  With ``bundles`` (product, member) a bundle's rows carry
    ``dataSubproduct`` = the member they came from."""
    p = parse_products(df, col)
    logs = p.select(F.col("d.productCode").alias("product"), F.explode("d.changeLogs").alias("c")).select("product", "c.*")
    if bundles is None:
        return logs
    b = bundles.select(F.col("product").alias("_bundle"), F.col("member").alias("product"))
    return logs.join(b, "product", "inner").select(F.col("_bundle").alias("product"),
                                                   F.col("product").alias("dataSubproduct"),
                                                   *[c for c in logs.columns if c != "product"])


def doi_table(df: DataFrame, col: str = "json") -> DataFrame:
    """(DPID, name, release, DOI) from DOI records
    ``{url, titles:[{title}], doi}``: release and product from the url, first
    title, ``https://doi.org/`` stripped."""
    schema = T.StructType([
        T.StructField("url", T.StringType()), T.StructField("doi", T.StringType()),
        T.StructField("titles", T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))),
    ])
    r = df.select(F.from_json(F.col(col), schema).alias("r"))
    url = F.col("r.url")
    return r.select(
        F.nullif(F.regexp_extract(url, r"DP[1-4]\.[0-9]{5}\.00[1-2]", 0), F.lit("")).alias("DPID"),
        F.try_element_at(F.col("r.titles"), F.lit(1)).getField("title").alias("name"),
        F.nullif(F.regexp_extract(url, r"RELEASE-[0-9]{4}", 0), F.lit("")).alias("release"),
        F.regexp_replace(F.col("r.doi"), "^https://doi.org/", "").alias("DOI"),
    )


def sensor_position_indices(positions: DataFrame, *, code: str = "HOR.VER", month: str = "month") -> DataFrame:
    """Distinct (HOR, VER) of the latest month: characters 1-3 and 5-7
    of the ``HOR.VER`` text.  The latest month is one aggregate, then a
    semi join (no window over a possibly hot single month)."""
    latest = positions.agg(F.max(month).alias(month))
    rows = positions.join(latest, month, "left_semi")
    text = F.col(f"`{code}`").cast("string")
    return rows.select(F.substring(text, 1, 3).alias("HOR"), F.substring(text, 5, 3).alias("VER")).distinct()


def time_indices(table_types: DataFrame, product: str, *, check: bool = True) -> DataFrame:
    """Distinct averaging intervals of a product other than 0; an
    unknown product raises."""
    rows = table_types.filter(F.col("productID") == product)
    if check and rows.agg(F.count(F.lit(1))).collect()[0][0] == 0:
        raise ValueError(f"unknown product {product}")
    return rows.select(F.col("tableTMI").alias("time_index")).filter(F.col("time_index") != 0).distinct()
