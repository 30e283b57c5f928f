"""Manifest operators: choosing which published files count.

A *manifest* is a DataFrame with one row per published file (columns
``MANIFEST_COLUMNS``).  Scan planning happens here, as data:
every filter and every "latest version" choice runs on the manifest before
any CSV is opened, so superseded files are never read.

Manifests are O(files), not O(rows); still, nothing here is collected to the
driver.  Latest-per-key choices use ``row_number()/rank() == 1`` which
Catalyst plans as a partial ``WindowGroupLimit`` before the shuffle, so a
key holding many files is cut down map-side.  A global latest is an ordered
top-1, never an unpartitioned window.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N

MANIFEST_COLUMNS = (
    "path", "name", "product", "domain", "site", "lab", "table", "table_type",
    "hor", "ver", "time_index", "month", "package", "publication", "release",
    "size", "md5",
)
METADATA_KINDS = (
    "variables", "readme", "validation", "categoricalCodes",
    "sensor_positions", "science_review_flags",
)
UNDETERMINED = "undetermined"
AVERAGED_PATTERN = r"(?<![0-9]){}_?min(?![A-Za-z])"
_MONTH_RE = re.compile(r"^[0-9]{4}-[0-9]{2}$")
_POS_RE = re.compile(r"^[0-9A-Za-z]{3}$")


# --------------------------------------------------------------------------
# Identity from names
# --------------------------------------------------------------------------

def parse_file_names(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Add manifest columns parsed from each file's path and name.

    Keeps ``size``/``md5`` when the input has them; ``table`` and
    ``table_type`` come from :func:`classify_tables`.
    """
    path = F.col(path_col)
    name = N.basename(path)
    cols = {
        "path": path.cast("string"),
        "name": name,
        "product": N.product_of(name),
        "domain": N.domain_of(name),
        "site": N.site_of(name),
        "lab": N.lab_of(name),
        "hor": N.hor_of(name),
        "ver": N.ver_of(name),
        "time_index": N.time_index_of(name),
        "month": F.coalesce(N.month_of(name), N.month_of(N.basename(N.dirname(path)))),
        "package": F.coalesce(N.package_of(name), N.package_of(N.basename(N.dirname(path)))),
        "publication": F.coalesce(N.publication_stamp(name), N.publication_stamp(path)),
        "release": N.release_of(path),
    }
    extra = [c for c in files.columns if c not in cols and c != path_col]
    out = files.select(*[v.alias(k) for k, v in cols.items()], *extra)
    for c, t in (("size", "bigint"), ("md5", "string")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return classify_tables(out)


#: Fixed value: longer name parts are no table names.
LONGEST_TABLE_NAME = 50


def classify_tables(manifest: DataFrame) -> DataFrame:
    """C3 + C4: per file ``table`` and ``table_type``.

    Data tables follow the name rules (parts of over 50 characters are no table
    names); ``sensor_positions`` files are typed
    ``site-all`` and ``science_review_flags`` files ``site-date``.
    Metadata files other than those two get null ``table``.
    """
    name = F.col("name")
    meta = F.col("_meta")
    with_meta = manifest.withColumn("_meta", N.metadata_table_of(name))
    with_table = with_meta.withColumn("table", F.coalesce(N.table_of(name, LONGEST_TABLE_NAME), meta))
    ttype = (
        F.when(meta == "sensor_positions", F.lit("site-all"))
        .when(meta == "science_review_flags", F.lit("site-date"))
        .otherwise(N.table_type_of(name))
    )
    return with_table.withColumn(
        "table_type", F.when(F.col("table").isNotNull(), ttype)
    ).drop("_meta")


def table_type_summary(manifest: DataFrame) -> DataFrame:
    """C3 check rows: per table, number of distinct types and the sorted types."""
    return (
        manifest.filter(F.col("table").isNotNull())
        .groupBy("table")
        .agg(
            F.count_distinct("table_type").cast("bigint").alias("n_types"),
            F.array_join(F.array_sort(F.collect_set("table_type")), ",").alias("table_types"),
            F.count(F.lit(1)).cast("bigint").alias("n_files"),
        )
    )


def table_types(manifest: DataFrame, *, check: bool = True) -> DataFrame:
    """Distinct (table, table_type); raises on conflicting types or no table.

    The check is one small aggregate over the manifest."""
    summary = table_type_summary(manifest)
    if check:
        row = summary.agg(
            F.count(F.lit(1)).alias("n"),
            F.max("n_types").alias("worst"),
            F.max_by("table", "n_types").alias("table"),
        ).collect()[0]
        if row["n"] == 0:
            raise ValueError("no data tables found, only metadata")
        if row["worst"] > 1:
            raise ValueError(
                f"files of {row['table']} are of several kinds (by site, by month or by lab); "
                "choose one release at a time"
            )
    return (
        manifest.filter(F.col("table").isNotNull())
        .select("table", "table_type")
        .distinct()
    )


def table_names_by_position(manifest: DataFrame, known_tables: DataFrame) -> DataFrame:
    """Table names of the older naming scheme.

    A name part equal to a known ``tableName`` counts; so does the part at a
    fixed position for names of 4, 10/11, 12 and 14 dot parts.  Distinct.
    """
    parts = F.transform(N.name_parts(F.col("name")), lambda p: F.regexp_replace(p, "_pub", ""))
    n = F.size(parts)
    positional = (
        F.when(n == 4, F.try_element_at(parts, F.lit(3)))
        .when(n.isin(10, 11), F.try_element_at(parts, F.lit(7)))
        .when(n == 12, F.try_element_at(parts, F.lit(11)))
        .when(n == 14, F.try_element_at(parts, F.lit(10)))
    )
    by_position = manifest.select(positional.alias("table")).filter(F.col("table").isNotNull())
    exploded = manifest.select(F.explode(parts).alias("table"))
    known = known_tables.select(F.col("tableName").alias("table")).distinct()
    by_name = exploded.join(known, "table", "left_semi")
    return by_name.unionByName(by_position).distinct()


# --------------------------------------------------------------------------
# filters
# --------------------------------------------------------------------------

def filter_sites(manifest: DataFrame, sites) -> DataFrame:
    """``'all'`` keeps everything; a list or a one-column DataFrame of
    sites keeps their intersection with the manifest."""
    if isinstance(sites, str) and sites == "all":
        return manifest
    if isinstance(sites, DataFrame):
        wanted = sites.select(F.col(sites.columns[0]).alias("site")).distinct()
        return manifest.join(wanted, "site", "left_semi")
    if isinstance(sites, str):
        sites = [sites]
    return manifest.filter(F.col("site").isin(list(sites)))


def check_month(value: str | None, what: str) -> None:
    if value is not None and not _MONTH_RE.match(value):
        raise ValueError(f"{what} must be YYYY-MM, got {value!r}")


def filter_months(
    manifest: DataFrame,
    start: str | None = None,
    end: str | None = None,
    *,
    keep_undated: bool = True,
) -> DataFrame:
    """Inclusive ``YYYY-MM`` range, either end open.  Files without a
    month (site-all, lab, metadata) are kept unless ``keep_undated=False``."""
    check_month(start, "start")
    check_month(end, "end")
    m = F.col("month")
    cond = F.lit(True)
    if start is not None:
        cond = cond & (m >= start)
    if end is not None:
        cond = cond & (m <= end)
    if keep_undated:
        cond = m.isNull() | cond
    return manifest.filter(cond)


def filter_release(
    manifest: DataFrame, release: str = "current", include_provisional: bool = False
) -> DataFrame:
    """``current``, one ``RELEASE-YYYY`` or ``PROVISIONAL``."""
    r = F.col("release")
    if release == "current":
        if include_provisional:
            return manifest
        return manifest.filter(r.isNull() | (r != "PROVISIONAL"))
    if release == "PROVISIONAL":
        if not include_provisional:
            raise ValueError(
                "release='PROVISIONAL' needs include_provisional=True"
            )
        return manifest.filter(r == "PROVISIONAL")
    if not re.match(r"^RELEASE-[0-9]{4}$", release):
        raise ValueError(f"unknown release {release!r}")
    if include_provisional:
        warnings.warn(
            f"include_provisional is ignored when a release is named; only {release} is kept",
            stacklevel=2,
        )
    return manifest.filter(r == release)


def filter_package(manifest: DataFrame, package: str = "basic") -> DataFrame:
    """Per (site, month), ``expanded`` falls back to ``basic`` when the
    site-month has no expanded file; when no file matches the chosen package
    (an expanded package may carry basic-named files) all candidates stay."""
    if package not in ("basic", "expanded"):
        raise ValueError("package must be basic or expanded")
    flags = manifest.groupBy(F.col("site").alias("_site"), F.col("month").alias("_month")).agg(
        F.coalesce(F.bool_or(F.col("package") == "expanded"), F.lit(False)).alias("_expanded"),
        F.coalesce(F.bool_or(F.col("package") == "basic"), F.lit(False)).alias("_basic"),
    )
    wants_expanded = F.lit(package == "expanded") & F.col("_expanded")
    keep = F.when(wants_expanded, F.col("package") == "expanded").when(F.col("_basic"), F.col("package") == "basic").otherwise(F.lit(True))
    same = F.col("site").eqNullSafe(F.col("_site")) & F.col("month").eqNullSafe(F.col("_month"))
    return manifest.join(flags, same).filter(keep).select(*[manifest[c] for c in manifest.columns])


def is_metadata(name_col: Column | str = "name") -> Column:
    name = F.col(name_col) if isinstance(name_col, str) else name_col
    parts = N.name_parts(name)
    return F.exists(parts, lambda p: p.isin(*METADATA_KINDS))


def filter_time_index(manifest: DataFrame, time_index: str | int | None) -> DataFrame:
    """Keep names with the averaging ``<n>min`` or ``<n>_min`` and every
    name without one (metadata and non-averaged tables).  The digits must be
    the whole number: 5 doesn't keep ``15min``."""
    if time_index in (None, "all"):
        return manifest
    n = int(time_index)
    name = F.col("name")
    return manifest.filter(~name.rlike(AVERAGED_PATTERN.format("[0-9]+")) | name.rlike(AVERAGED_PATTERN.format(n)))


def filter_table(manifest: DataFrame, table: str, metadata: bool = True) -> DataFrame:
    """C11: names containing ``.table.`` (or ``.table_pub.``), with or
    without the metadata files."""
    name = F.col("name")
    hit = name.contains(f".{table}.") | name.contains(f".{table}_pub.")
    if metadata:
        hit = hit | is_metadata(name)
    return manifest.filter(hit)


def check_position(value: str | None, what: str) -> None:
    if value is None or not _POS_RE.match(str(value)):
        raise ValueError(f"{what} must be one 3-character index, got {value!r}")


def filter_position(manifest: DataFrame, hor: str, ver: str, *, table: str | None = None) -> DataFrame:
    """Exactly one HOR and VER.  Ignored (with a warning) for
    observational tables (no file has a position) and ``ais_`` tables; files
    without a position (metadata) stay.  A position that no file has raises."""
    if table is not None and table.startswith("ais_"):
        warnings.warn("ais_ tables have no positions to choose from; hor and ver are ignored", stacklevel=2)
        return manifest
    check_position(hor, "hor")
    check_position(ver, "ver")
    positioned = F.col("hor").isNotNull()
    seen = manifest.agg(
        F.coalesce(F.bool_or(positioned), F.lit(False)).alias("any"),
        F.coalesce(F.bool_or((F.col("hor") == hor) & (F.col("ver") == ver)), F.lit(False)).alias("here"),
    ).first()
    if not seen["any"]:
        warnings.warn("the files have no sensor positions; hor and ver are ignored", stacklevel=2)
        return manifest
    if not seen["here"]:
        raise ValueError(f"no file at position {hor}.{ver}")
    return manifest.filter(~positioned | ((F.col("hor") == hor) & (F.col("ver") == ver)))


# --------------------------------------------------------------------------
# Latest publication
# --------------------------------------------------------------------------

def publication_order() -> list[Column]:
    """Newest first: by the stamp in the basename, then by one in the path,
    then by name; a file without a stamp never beats one with it."""
    return [
        N.publication_stamp(F.col("name")).desc_nulls_last(),
        N.publication_stamp(F.col("path")).desc_nulls_last(),
        F.col("name").desc_nulls_last(),
        F.col("path").asc(),
    ]


def latest_publication(manifest: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """Per key, the file with the greatest publication stamp; ties go
    to the greatest name, then the first path.  Adds ``latest_stamp`` (the
    stamp, or ``undetermined`` when the chosen file has none)."""
    if keys:
        w = Window.partitionBy(*keys).orderBy(*publication_order())
        out = manifest.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    else:
        out = manifest.orderBy(*publication_order()).limit(1)
    stamp = F.coalesce(N.publication_stamp(F.col("name")), N.publication_stamp(F.col("path")), F.lit(UNDETERMINED))
    return out.withColumn("latest_stamp", stamp)


def select_files_by_type(manifest: DataFrame) -> DataFrame:
    """C14: site-date files all count, also where a manifest repeats a path; a
    site-all table keeps its latest file per site; a lab table its latest per
    lab.  Dated files, nearly all of a store, pass without a shuffle; only the
    others are ranked.  Rows of any other type go."""
    tt = F.col("table_type")
    owner = F.when(tt == "lab", F.col("lab")).otherwise(F.col("site"))
    dated = manifest.filter(tt == "site-date")
    newest = latest_publication(manifest.filter(tt.isin("site-all", "lab")), ["table", "table_type", owner])
    return dated.unionByName(newest.drop("latest_stamp"))


def pubdate_stamp(pubdate: str) -> str:
    """``YYYY-MM-DD`` to the stamp of that day's midnight."""
    if not re.match(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", pubdate):
        raise ValueError(f"pubdate must be YYYY-MM-DD, got {pubdate!r}")
    return pubdate.replace("-", "") + "T000000Z"


def published_by(manifest: DataFrame, pubdate: str, *, check: bool = False) -> DataFrame:
    """The files that were published by ``pubdate``, and those without a stamp.
    With ``check`` raises when no variables file is among the stamped ones."""
    stamp = N.publication_stamp(F.col("name"))
    old = manifest.filter(stamp.isNull() | (stamp <= pubdate_stamp(pubdate)))
    if check and old.filter(F.col("name").contains(".variables.") & stamp.isNotNull()).isEmpty():
        raise ValueError(f"the store holds no variables file as old as {pubdate}")
    return old


def as_of_publication(manifest: DataFrame, pubdate: str | None = None, *, check: bool = False) -> DataFrame:
    """The store as it stood on ``pubdate``.

    Files published after ``pubdate`` go (files without a stamp stay); then
    each (table, site, month) of a dated table keeps its latest stamp at or
    before ``pubdate`` (all files sharing that stamp).  Other files pass.
    With ``check=True`` raises when no variables file is old enough.
    """
    df = manifest if pubdate is None else published_by(manifest, pubdate, check=check)
    df = df.withColumn("_stamp", N.publication_stamp(F.col("name")))
    # one window: a file that no choice concerns is a group of its own
    alone = F.col("table").isNull() | F.col("site").isNull() | F.col("month").isNull() | F.col("_stamp").isNull()
    w = Window.partitionBy("table", "site", "month", F.when(alone, F.col("path"))).orderBy(F.col("_stamp").desc())
    return df.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk", "_stamp")


def dedupe_file_versions(manifest: DataFrame) -> DataFrame:
    """Strip the stamp from each name, keep the greatest name per stem."""
    stem = F.regexp_replace(F.col("name"), N.STAMP_PATTERN, "")
    cols = manifest.columns
    return (
        manifest.withColumn("_stem", stem)
        .groupBy("_stem")
        .agg(F.max_by(F.struct(*cols), F.struct("name", "path")).alias("_r"))
        .select("_r.*")
    )


# --------------------------------------------------------------------------
# Variables files and package contents
# --------------------------------------------------------------------------

def attach_variables_file(manifest: DataFrame) -> DataFrame:
    """C17: each data file gets path and md5 of the variables file of its
    (release, site, month) when exactly one exists, else null."""
    is_var = F.col("name").contains(".variables.")
    keys = ["release", "site", "month"]
    var = (
        manifest.filter(is_var)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("path").alias("variables_path"),
            F.min("md5").alias("variables_md5"),
        )
        .filter("_n = 1")
        .drop("_n")
    )
    data = manifest.filter(~is_var)
    # null keys match nothing, and would all meet in one task of the join
    whole = F.col("release").isNotNull() & F.col("site").isNotNull() & F.col("month").isNotNull()
    matched = data.filter(whole).join(var.dropna(subset=keys), keys, "left")
    return matched.unionByName(data.filter(~whole), allowMissingColumns=True)


def _stamp_ts(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss'Z'"))


def match_variables_by_publication(
    data: DataFrame, variables: DataFrame, *, by: Sequence[str] = ("product",)
) -> DataFrame:
    """Each data file gets the variables file with the same stamp, else
    the nearest stamp (by full timestamp); equal gaps go to the earlier one,
    and of several variables files with one stamp the first path counts.

    Only distinct stamps of a ``by`` group are sorted together, never its
    files: stamps of both sides are interleaved and the variables file is
    carried backwards and forwards; the files then join their stamp.
    """
    by = list(by)
    stamp = N.publication_stamp(F.col("name"))
    v = (
        variables.select(*by, stamp.alias("_stamp"), F.col("path").alias("_vp"))
        .filter(F.col("_stamp").isNotNull())
        .groupBy(*by, "_stamp")
        .agg(F.min("_vp").alias("_vpath"))
        .withColumn("_is_data", F.lit(0))
    )
    d = data.select(*by, stamp.alias("_stamp")).filter(F.col("_stamp").isNotNull()).distinct().withColumn("_is_data", F.lit(1))
    both = d.unionByName(v, allowMissingColumns=True)
    # Both directions use a growing frame (unbounded preceding .. current
    # row), which Spark evaluates in one pass; a frame running to unbounded
    # following would be recomputed per row (quadratic).
    var_row = F.when(F.col("_is_data") == 0, F.struct(F.col("_stamp").alias("s"), F.col("_vpath").alias("p")))
    up = Window.partitionBy(*by).orderBy(F.col("_stamp").asc(), F.col("_is_data").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*by).orderBy(F.col("_stamp").desc(), F.col("_is_data").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev_v = F.last(var_row, ignorenulls=True).over(up)
    next_v = F.last(var_row, ignorenulls=True).over(down)
    out = both.withColumn("_prev", prev_v).withColumn("_next", next_v).filter("_is_data = 1")
    ts = F.unix_seconds(_stamp_ts(F.col("_stamp")))
    gap_prev = ts - F.unix_seconds(_stamp_ts(F.col("_prev.s")))
    gap_next = F.unix_seconds(_stamp_ts(F.col("_next.s"))) - ts
    pick_next = F.col("_prev").isNull() | (F.col("_next").isNotNull() & (gap_next < gap_prev))
    chosen = F.when(pick_next, F.col("_next")).otherwise(F.col("_prev"))
    matched = out.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_stamp").alias("_at"), chosen.alias("_chosen"))
    same = (stamp == F.col("_at"))
    for c in by:
        same = same & data[c].eqNullSafe(F.col(f"_{c}"))
    return data.join(matched, same, "left").select(
        *[data[c] for c in data.columns],
        F.col("_chosen.p").alias("variables_path"),
        F.col("_chosen.s").alias("variables_publication"),
    )


def table_package_status(variables: DataFrame) -> DataFrame:
    """Per table ``basic``, ``expanded`` or ``both`` from the
    ``downloadPkg`` values other than ``none``; all ``none`` gives ``none``."""
    pkg = F.col("downloadPkg")
    return (
        variables.groupBy("table")
        .agg(
            F.max((pkg == "basic").cast("int")).alias("_b"),
            F.max((pkg == "expanded").cast("int")).alias("_e"),
            F.max((~pkg.isin("basic", "expanded", "none")).cast("int")).alias("_o"),
        )
        .select(
            "table",
            F.when((F.col("_b") == 0) & (F.col("_e") == 0) & (F.col("_o") == 0), "none")
            .when((F.col("_b") == 1) & (F.col("_e") == 0) & (F.col("_o") == 0), "basic")
            .when((F.col("_e") == 1) & (F.col("_b") == 0) & (F.col("_o") == 0), "expanded")
            .otherwise("both")
            .alias("package_status"),
        )
    )


def tables_in_package(manifest: DataFrame, status: DataFrame, package: str, *, fallback: bool = False) -> DataFrame:
    """C20: files of the tables a package contains, plus metadata files.

    expanded: every table; basic: ``basic`` and ``both`` tables.  For
    ``both`` tables the other package's files are removed, with ``fallback``
    only where the table's site-month was published in the asked one."""
    if package not in ("basic", "expanded"):
        raise ValueError("package must be basic or expanded")
    wanted = status if package == "expanded" else status.filter(F.col("package_status").isin("basic", "both"))
    wanted = wanted.select("table", "package_status")
    meta = manifest.filter(is_metadata("name"))
    data = manifest.filter(~is_metadata("name")).join(wanted, "table", "inner")
    other = "basic" if package == "expanded" else "expanded"
    drop = (F.col("package_status") == "both") & (F.col("package") == other)
    if fallback:
        keys = ("table", "site", "month")
        own = data.filter(F.col("package") == package).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_own", F.lit(True))
        same = (F.col("table") == F.col("_table")) & F.col("site").eqNullSafe(F.col("_site")) & F.col("month").eqNullSafe(F.col("_month"))
        data, drop = data.join(own, same, "left"), drop & F.col("_own").isNotNull()
    return data.filter(~F.coalesce(drop, F.lit(False))).select(*manifest.columns).unionByName(meta)


def missing_tables(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected tables with no file in the manifest."""
    present = manifest.select("table").filter(F.col("table").isNotNull()).distinct()
    return expected.select("table").distinct().join(present, "table", "left_anti")


# --------------------------------------------------------------------------
# lookups
# --------------------------------------------------------------------------

# The site whose met station moved, the site it moved from, and
# the releases in which the old mapping still holds.
MOVED_SITE = "BLWA"
MOVED_FROM = "DELA"
MOVED_SITE_RELEASES = ("RELEASE-2021", "RELEASE-2022", "RELEASE-2023", "RELEASE-2024", "RELEASE-2025")


def redirect_sites(requests: DataFrame, lookup: DataFrame, product: str, release: str | None = None) -> DataFrame:
    """Requested sites -> the site whose files serve them.

    ``lookup`` has (site, towerSite, product); a (site, product) hit maps to
    the tower site, anything else maps to itself.  The moved-station rule:
    when the moved site is requested outside the listed releases and its old
    host isn't requested, its mapping is dropped and the old host is added.
    """
    req = requests.select(F.col(requests.columns[0]).alias("site")).distinct()
    lk = lookup.filter(F.col("product") == product).select("site", "towerSite")
    if release not in MOVED_SITE_RELEASES:
        # one scalar check row decides whether the moved-station rule applies
        flags = req.join(lk.select("site").distinct(), "site", "left_outer").agg(
            F.max((F.col("site") == MOVED_SITE).cast("int")).alias("has_moved"),
            F.max((F.col("site") == MOVED_FROM).cast("int")).alias("has_from"),
        ).collect()[0]
        hits = req.join(lk, "site", "left_semi").agg(F.count(F.lit(1))).collect()[0][0]
        if hits and flags["has_moved"] == 1 and not flags["has_from"]:
            lk = lk.filter(F.col("site") != MOVED_SITE)
            req = req.unionByName(req.sparkSession.range(1).select(F.lit(MOVED_FROM).alias("site")))
    out = req.join(lk, "site", "left").select(
        F.col("site").alias("requested_site"),
        F.coalesce(F.col("towerSite"), F.col("site")).alias("site"),
    )
    return out.distinct()


def redirect_flight_sites(requests: DataFrame, lookup: DataFrame) -> DataFrame:
    """Site -> flight site when listed in the (site, flightSite) lookup."""
    site_col = requests.columns[0]
    lk = lookup.select(F.col("site").alias("_s"), "flightSite")
    return requests.join(lk, F.col(site_col) == F.col("_s"), "left").select(
        *[F.col(c) for c in requests.columns],
        F.coalesce(F.col("flightSite"), F.col(site_col)).alias("flight_site"),
    )


# The buoy air-temperature product, the product that includes it
# since 2025, and the releases in which it still stood alone.
BUOY_PRODUCT, BUOY_HOME = "DP1.20046.001", "DP1.20271.001"
BUOY_ALONE = ("RELEASE-2021", "RELEASE-2022", "RELEASE-2023", "RELEASE-2024")


def resolve_bundles(products: DataFrame, chem_bundles: DataFrame, other_bundles: DataFrame,
                    release: str | None = None) -> DataFrame:
    """Status ``ok``/``moved``/``ambiguous`` and the home product.

    Chemistry bundles always apply; other bundles apply except in
    RELEASE-2021; the buoy product moved after RELEASE-2024; a home product
    ``depends`` is ambiguous."""
    pcol = products.columns[0]
    chem = chem_bundles.select(F.col("product").alias("_cp"), F.col("homeProduct").alias("_ch"))
    other = other_bundles.select(F.col("product").alias("_op"), F.col("homeProduct").alias("_oh"))
    if release == "RELEASE-2021":
        other = other.limit(0)
    out = (
        products.join(chem, F.col(pcol) == F.col("_cp"), "left")
        .join(other, F.col(pcol) == F.col("_op"), "left")
    )
    home = F.coalesce(F.col("_ch"), F.col("_oh"))
    if release not in BUOY_ALONE:
        home = F.coalesce(home, F.when(F.col(pcol) == BUOY_PRODUCT, BUOY_HOME))
    return out.select(
        *[F.col(c) for c in products.columns],
        F.when(home.isNull(), "ok").when(home == "depends", "ambiguous").otherwise("moved").alias("status"),
        F.when(home.isNull(), F.col(pcol)).when(home == "depends", F.lit(None)).otherwise(home).alias("home_product"),
    )


# --------------------------------------------------------------------------
# C32, C33, C35
# --------------------------------------------------------------------------

def size_text(total_bytes: Column) -> Column:
    """Decimal megabytes below 1000 MB, else gigabytes, e.g. ``12.5 MB``."""
    mb = total_bytes.cast("double") / 1e6
    gb = total_bytes.cast("double") / 1e9

    def num(x: Column) -> Column:
        return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))

    return F.when(mb < 1000, F.concat(num(mb), F.lit(" MB"))).otherwise(F.concat(num(gb), F.lit(" GB")))


def download_size(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total size (nulls ignored) and its text form."""
    total = F.coalesce(F.sum("size"), F.lit(0)).cast("bigint")
    agg = manifest.groupBy(*by).agg(total.alias("total_bytes"))
    return agg.withColumn("size_text", size_text(F.col("total_bytes")))


def latest_metadata_files(manifest: DataFrame) -> DataFrame:
    """Newest readme overall, newest sensor-position file per site, all
    variables files and every science-review file."""
    name = F.col("name")
    readme = latest_publication(manifest.filter(name.contains(".readme.")), []).drop("latest_stamp")
    sensor = latest_publication(manifest.filter(name.contains(".sensor_positions.")), ["site"]).drop("latest_stamp")
    var = manifest.filter(name.contains(".variables."))
    srf = manifest.filter(name.contains(".science_review_flags."))
    return readme.unionByName(sensor).unionByName(var).unionByName(srf)


PRODUCT_ID_PATTERN = r"^DP[1-4]\.[0-9]{5}\.00[1-2]$"


def product_id_check(manifest: DataFrame) -> DataFrame:
    """C35 check row: distinct products, how many are malformed, and the
    package (``expanded`` if any file is expanded)."""
    return manifest.agg(
        F.count_distinct("product").cast("bigint").alias("n_products"),
        F.count_distinct(F.when(~F.col("product").rlike(PRODUCT_ID_PATTERN), F.col("product"))).cast("bigint").alias("n_invalid"),
        F.when(F.max((F.col("package") == "expanded").cast("int")) == 1, "expanded").otherwise("basic").alias("package"),
    )


def validate_product_id(manifest: DataFrame) -> str:
    """Raises unless there is exactly one well-formed product id;
    returns the package of the files."""
    row = product_id_check(manifest).collect()[0]
    if row["n_products"] != 1:
        raise ValueError(f"files must hold exactly one product, found {row['n_products']}")
    if row["n_invalid"]:
        raise ValueError("malformed product id")
    return row["package"]
