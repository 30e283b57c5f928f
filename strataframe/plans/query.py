"""Lazy query surface (Q1-Q5) and the one-call file selection."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import manifest as M
from ..operators import stack as ST
from ..session import write_once
from ..sources import csv as C

# The flux bundle and its members, and what the catalogue calls
# the kinds of remote sensing and of sensor products.
FLUX_PRODUCTS = (
    "DP1.00007.001", "DP1.00010.001", "DP1.00030.001", "DP1.00034.001", "DP1.00035.001", "DP1.00036.001", "DP1.00037.001",
    "DP1.00099.001", "DP1.00100.001", "DP2.00008.001", "DP2.00009.001", "DP2.00024.001", "DP3.00008.001", "DP3.00009.001",
    "DP3.00010.001", "DP4.00002.001", "DP4.00007.001", "DP4.00067.001", "DP4.00137.001", "DP4.00200.001", "DP4.00201.001",
)
FLUX_BUNDLE = "DP4.00200.001"
AIRBORNE_KINDS = ("AOP Data Product Type",)
SENSOR_KINDS = ("TIS Data Product Type", "AIS Data Product Type")


def filter_files(manifest: DataFrame, *, sites="all", start: str | None = None, end: str | None = None,
                 package: str = "basic", release: str = "current", include_provisional: bool = False,
                 time_index=None, table: str | None = None, metadata: bool = True, written: str | None = None) -> DataFrame:
    """C6-C11 one after another.  Table and time index together raise.  C9 needs
    its files twice; with ``written``, those of C6-C8 are written under the
    shared folder by that label, so that the whole manifest is gone over once."""
    if table is not None and time_index not in (None, "all"):
        raise ValueError("choose a table or a time index, not both")
    man = M.filter_sites(manifest, sites)
    man = M.filter_months(man, start, end)
    man = M.filter_release(man, release, include_provisional)
    if written is not None:
        man = write_once(man, written)
    man = M.filter_package(man, package)
    man = M.filter_time_index(man, time_index)
    if table is not None:
        man = M.filter_table(man, table, metadata)
    return man


# Products whose files are hosted elsewhere, and the product
# whose expanded package is too large to be fetched as one.
HOSTED_ELSEWHERE = ("DP1.00033.001", "DP1.00042.001", "DP1.00043.001")
BASIC_ONLY = ("DP1.10017.001",)


def refuse_product(product: str, package: str = "basic") -> None:
    """Products that can't be selected, by their id alone."""
    if product in HOSTED_ELSEWHERE:
        raise ValueError(f"the files of {product} are hosted elsewhere")
    if product in BASIC_ONLY and package == "expanded":
        raise ValueError(f"the expanded package of {product} is too large; choose the basic one")
    if product in FLUX_PRODUCTS and product != FLUX_BUNDLE:
        raise ValueError(f"{product} is only in the bundle {FLUX_BUNDLE}")


def select_product_files(manifest: DataFrame, product: str | None = None, *, sites="all", start: str | None = None,
                         end: str | None = None, package: str = "basic", release: str = "current",
                         include_provisional: bool = False, time_index=None, table: str | None = None,
                         metadata: bool = True, shared_sites: DataFrame | None = None,
                         chem_bundles: DataFrame | None = None, other_bundles: DataFrame | None = None) -> DataFrame:
    """The files that a request for a product means, nothing fetched; the
    columns of ``manifest`` and

    * ``role``: data, or which metadata the file is,
    * ``requested_sites``: the asked sites that it serves, comma-joined, where
      ``shared_sites`` sends an aquatic site to its tower site (C22; null for
      ``sites="all"``),
    * ``bundle_status`` and ``home_product`` (C24; from the two bundle tables),
    * ``total_bytes`` and ``size_text``: all that the request would fetch (C32).

    The files are those of C6-C11; where a table or a time index is chosen, the
    metadata beside them is the newest readme, the newest sensor positions of
    each site, every variables file and every review file (C33), or none with
    ``metadata=False``.  Without ``product``, those of all products.

    The manifest is gone over once, here: its files of C6-C8 and then those
    chosen are written under the shared folder, and the newest metadata, the
    bundles and the size start from the few that were written.

    What the arguments alone rule out raises at once: table and time index
    together, products hosted elsewhere, members of the flux bundle; so does a
    table that labs publish, which belongs to no site or month and can't be
    chosen alone.  A product that was moved into another (or ambiguously) fails
    the plan when it runs."""
    if table is not None and time_index not in (None, "all"):
        raise ValueError("choose a table or a time index, not both")
    man = manifest
    if product is not None:
        refuse_product(product, package)
        man = man.filter(F.col("product") == product)
    served = None
    if not (isinstance(sites, str) and sites == "all"):
        asked = sites if isinstance(sites, DataFrame) else manifest.sparkSession.createDataFrame([(s,) for s in ([sites] if isinstance(sites, str) else sites)], "site string")
        if shared_sites is not None and product is not None:
            served = M.redirect_sites(asked, shared_sites, product, None if release == "current" else release)
        else:
            names = asked.select(F.col(asked.columns[0]).alias("site")).distinct()
            served = names.select(F.col("site").alias("requested_site"), "site")
        sites = served.select("site")
    chosen = filter_files(man, sites=sites, start=start, end=end, package=package, release=release,
                          include_provisional=include_provisional, time_index=time_index, table=table, metadata=True, written="request")
    if table is not None:
        alone = (F.col("table") == table) & (F.col("table_type") == "lab")
        said = F.raise_error(F.lit(f"{table} is published by labs, not by site and month; it can't be chosen alone"))
        chosen = chosen.filter(F.when(alone, said.cast("boolean")).otherwise(F.lit(True)))
    chosen = write_once(chosen, "chosen")
    if table is not None or time_index not in (None, "all"):
        data = chosen.filter(~M.is_metadata("name"))
        chosen = data.unionByName(M.latest_metadata_files(chosen)) if metadata else data
    elif not metadata:
        chosen = chosen.filter(~M.is_metadata("name"))
    parts = N.name_parts(F.col("name"))
    role = F.try_element_at(F.filter(parts, lambda p: p.isin(*M.METADATA_KINDS)), F.lit(1))
    out = chosen.withColumn("role", F.coalesce(role, F.lit("data")))
    if served is None:
        out = out.withColumn("requested_sites", F.lit(None).cast("string"))
    else:
        asked_by = served.groupBy(F.col("site").alias("_site")).agg(F.array_join(F.array_sort(F.collect_set("requested_site")), ",").alias("requested_sites"))
        out = out.join(asked_by, F.col("site") == F.col("_site"), "left").drop("_site")
    out = _with_bundles(out, chem_bundles, other_bundles, None if release == "current" else release)
    total = chosen.agg(F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total")).scalar()
    return out.withColumn("total_bytes", total).withColumn("size_text", M.size_text(F.col("total_bytes")))


def _with_bundles(files: DataFrame, chem: DataFrame | None, other: DataFrame | None, release: str | None) -> DataFrame:
    """Files with their product's bundle status; one that isn't ok fails."""
    if chem is None and other is None:
        return files.withColumn("bundle_status", F.lit(None).cast("string")).withColumn("home_product", F.lit(None).cast("string"))
    none = files.sparkSession.createDataFrame([], "product string, homeProduct string")
    products = files.select("product").distinct()
    status = M.resolve_bundles(products, chem if chem is not None else none, other if other is not None else none, release)
    said = F.raise_error(F.concat(
        F.col("_p"), F.when(F.col("bundle_status") == "ambiguous", F.lit(" is in several bundles; choose one")).otherwise(F.concat(F.lit(" is bundled in "), F.col("home_product")))
    ))
    checked = status.select(F.col("product").alias("_p"), F.col("status").alias("bundle_status"), "home_product")
    met = files.join(checked, F.col("product").eqNullSafe(F.col("_p")), "left")
    return met.filter(F.when(F.col("bundle_status") != "ok", said.cast("boolean")).otherwise(F.lit(True))).drop("_p")


def query_files(manifest: DataFrame, *, sites="all", start: str | None = None, end: str | None = None,
                package: str = "basic", release: str = "current", include_provisional: bool = False,
                time_index=None, table: str | None = None, metadata: bool = True) -> dict:
    """Q5: surviving files of C6-C11 (with their variables file, C17), the newest
    variables file, whether more than one variables version is present, and
    the newest path per variables md5."""
    man = filter_files(manifest, sites=sites, start=start, end=end, package=package,
                               release=release, include_provisional=include_provisional,
                               time_index=time_index, table=table, metadata=True)
    var = man.filter(F.col("name").contains(".variables."))
    files = M.attach_variables_file(man)
    if not metadata:
        files = files.filter(~M.is_metadata("name"))
    newest = M.latest_publication(var, []).select("path", "md5")
    per_md5 = var.groupBy("md5").agg(F.max_by("path", "publication").alias("path"))
    versions = var.agg((F.count_distinct("md5") > 1).alias("several_versions"))
    return {"files": files, "newest_variables": newest, "variables_by_md5": per_md5, "versions": versions}


def check_queryable(products: list[str], kinds: DataFrame | None = None) -> str | None:
    """Raises unless the tables asked for are of one product with tables to
    query: not the flux bundle or one of its members, nor remote sensing, which
    the catalogue's ``kinds(product, kind)`` says.  Returns the product's kind."""
    if len(products) > 1:
        raise ValueError(f"tables of one product are queried at a time, not of {products}")
    flux = sorted(set(products) & set(FLUX_PRODUCTS))
    if flux:
        raise ValueError(f"{flux[0]} is a flux product; its series can't be queried as tables")
    if kinds is None or not products:
        return None
    row = kinds.filter(F.col("product") == products[0]).select("kind").first()
    if row is not None and row["kind"] in AIRBORNE_KINDS:
        raise ValueError(f"{products[0]} is a remote sensing product; it has no tables to query")
    return None if row is None else row["kind"]


def dataset_query(spark: SparkSession, manifest: DataFrame, *, table: str, sites="all",
                  start: str | None = None, end: str | None = None, package: str = "basic",
                  release: str = "current", include_provisional: bool = False,
                  hor: str | None = None, ver: str | None = None, kinds: DataFrame | None = None) -> DataFrame | None:
    """Q1: a lazy, uncollected scan of one table's current files, for the
    caller's DataFrame or SQL verbs: its cells as text, ``file``, and from the
    file's path ``siteID`` and ``domainID`` (of tables that lack them),
    ``month``, ``publicationDate`` and ``release``.

    Columns that aren't used aren't read, predicates on cells reach the reader,
    and those on what the path says choose the files.  Sensor tables need one
    site and one position; of observational and ``ais_`` tables a position is
    ignored with a warning.  Flux and remote sensing products, and files of more
    or less than exactly one table, raise.  None if no file is left.

    Arguments that don't fit the files raise here, when the query is planned:
    one pass over the manifest, none over the data."""
    if not table:
        raise ValueError("a table name is required")
    named = manifest.filter(F.col("table") == table)
    seen = named.agg(F.bool_or(F.col("hor").isNotNull()).alias("sensor"), F.array_sort(F.collect_set("product")).alias("products")).first()
    kind = check_queryable(seen["products"], kinds)
    if table.startswith("ais_"):
        if hor is not None or ver is not None:
            warnings.warn("ais_ tables have no positions to choose from; hor and ver are ignored", stacklevel=2)
        hor = ver = None
    elif kind in SENSOR_KINDS or (kind is None and seen["sensor"]):
        several = isinstance(sites, DataFrame) or sites == "all" or (not isinstance(sites, str) and len(list(sites)) != 1)
        if several or hor is None or ver is None:
            raise ValueError("a sensor table is queried for one site and one position: give sites, hor and ver")
    elif hor is not None or ver is not None:
        warnings.warn("the table is observational; hor and ver are ignored", stacklevel=2)
        hor = ver = None
    man = filter_files(manifest, sites=sites, start=start, end=end, package=package,
                               release=release, include_provisional=include_provisional,
                               table=table, metadata=False)
    if hor is not None or ver is not None:
        man = M.filter_position(man, hor, ver, table=table)
    man = write_once(M.select_files_by_type(M.as_of_publication(man, None)), "query-files")
    left = man.select("table", "table_type").distinct().limit(2).collect()
    if not left:
        return None
    if len(left) > 1:
        raise ValueError(f"the files are of more than one table: {sorted(r['table'] for r in left)}")
    if left[0]["table"] != table:
        warnings.warn(f"the files asked for as {table} name their table {left[0]['table']}", stacklevel=2)
    raw = C.scan_csv(spark, man, checked=False)
    if raw is None:
        return None
    placed = ST.with_position(ST.with_provenance(raw), left[0]["table_type"], has_position=bool(seen["sensor"]))
    return placed if "month" in placed.columns else placed.withColumn("month", N.month_of(N.basename("file")))


def events_by_type(df: DataFrame, event_type: str, column: str = "eventType") -> DataFrame:
    """Q3: equality predicate, pushed to the scan."""
    return df.filter(F.col(column) == event_type)


def latest_event_site(df: DataFrame, *, site_col: str = "siteID", date_col: str = "endDate") -> DataFrame:
    """Q4: site and month of the greatest ``endDate`` (nulls ignored)."""
    d = F.col(date_col)
    return df.filter(d.isNotNull()).agg(
        F.max_by(F.struct(F.col(site_col).alias("site"), d.alias("d")), F.struct(d, F.col(site_col))).alias("r")
    ).select(F.col("r.site").alias("site"), F.substring(F.col("r.d").cast("string"), 1, 7).alias("month"))

