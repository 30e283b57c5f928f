"""Checked queries for the manifest operators.

The input is the one-file-per-order manifest of ``shapes.MANIFEST_SQL``;
Spark parses the raw paths (C1) and runs the operator, the oracle reads the
truth columns the shape was built from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import manifest as M
from .registry import register
from .shapes import MANIFEST_SQL, shape, written_shape

M_CTE = f"WITH m AS ({MANIFEST_SQL})\n"

# Derived lookups used by several queries (from the tables).
REQUEST_SITES_SQL = """
SELECT DISTINCT 'ST' || lpad(cast(n_nationkey AS string), 2, '0') AS site
FROM nation WHERE n_regionkey IN (1, 3)
"""
SHARED_SITES_SQL = """
SELECT 'ST' || lpad(cast(n_nationkey AS string), 2, '0') AS site,
       'ST' || lpad(cast(n_regionkey AS string), 2, '0') AS towerSite,
       'DP1.00001.001' AS product
FROM nation WHERE n_nationkey >= 10
"""
FLIGHT_SITES_SQL = """
SELECT 'ST' || lpad(cast(n_nationkey AS string), 2, '0') AS site,
       'FL' || lpad(cast(n_regionkey AS string), 2, '0') AS flightSite
FROM nation WHERE n_nationkey % 3 = 0
"""
PRODUCTS_SQL = """
SELECT DISTINCT 'DP1.' || lpad(cast(10000 + p_size AS string), 5, '0') || '.001' AS product FROM part
"""
CHEM_BUNDLES_SQL = """
SELECT DISTINCT 'DP1.' || lpad(cast(10000 + p_size AS string), 5, '0') || '.001' AS product,
  CASE WHEN p_size = 11 THEN 'depends'
       ELSE 'DP1.' || lpad(cast(10000 + p_size - 1 AS string), 5, '0') || '.001' END AS homeProduct
FROM part WHERE p_size % 10 = 1
"""
OTHER_BUNDLES_SQL = """
SELECT DISTINCT 'DP1.' || lpad(cast(10000 + p_size AS string), 5, '0') || '.001' AS product,
  'DP1.' || lpad(cast(10000 + p_size - 2 AS string), 5, '0') || '.001' AS homeProduct
FROM part WHERE p_size % 10 = 2
"""
EXPECTED_TABLES_SQL = """
SELECT DISTINCT 'ord_' || CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'openSummary'
                               ELSE 'labPending' END AS tbl FROM orders
UNION
SELECT DISTINCT 'ord_' || lower(replace(o_orderpriority, '-', '_')) AS tbl FROM orders
"""
KNOWN_TABLES_SQL = """
SELECT DISTINCT CASE o_orderstatus WHEN 'P' THEN 'ord_labPending' ELSE 'ord_openSummary' END AS tableName
FROM orders
"""
# Package status per table as a variables table derived from the manifest.
PKG_VARIABLES_SQL = """
SELECT table_name AS tbl,
  CASE table_name WHEN 'ord_openSummary' THEN 'basic' WHEN 'ord_labPending' THEN 'expanded'
       ELSE package END AS downloadPkg
FROM m WHERE table_name IS NOT NULL
"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2-equivalent raw listing (path, size, md5) parsed by C1."""
    raw = written_shape(spark, sf_dir, MANIFEST_SQL, "manifest").select("path", "size", "md5", "file_id")
    return M.parse_file_names(raw)


def _out(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col("table").alias("table_name") if c == "table_name" else F.col(c) for c in cols])


@register("parse_file_names", M_CTE + """
SELECT path, name, product, domain, site, lab, table_name, table_type, hor, ver, time_index,
       month, package, publication, release, size, md5
FROM m
""")
def q_parse_file_names(spark, sf_dir):
    return _out(manifest(spark, sf_dir), "path", "name", "product", "domain", "site", "lab", "table_name",
                "table_type", "hor", "ver", "time_index", "month", "package", "publication", "release",
                "size", "md5")


@register("classify_tables", M_CTE + """
SELECT table_name, cast(count(DISTINCT table_type) AS bigint) AS n_types,
       string_agg(DISTINCT table_type, ',' ORDER BY table_type) AS table_types,
       cast(count(*) AS bigint) AS n_files
FROM m WHERE table_name IS NOT NULL GROUP BY table_name
""")
def q_classify_tables(spark, sf_dir):
    return M.table_type_summary(manifest(spark, sf_dir)).withColumnRenamed("table", "table_name")


@register("table_types", M_CTE + """
SELECT DISTINCT table_name, table_type FROM m WHERE table_name IS NOT NULL
""")
def q_table_types(spark, sf_dir):
    return M.table_types(manifest(spark, sf_dir)).withColumnRenamed("table", "table_name")


@register("add_metadata_tables", M_CTE + """
SELECT table_name, table_type, cast(count(*) AS bigint) AS n_files FROM m
WHERE table_name IN ('sensor_positions', 'science_review_flags') GROUP BY 1, 2
""")
def q_add_metadata_tables(spark, sf_dir):
    m = manifest(spark, sf_dir).filter(F.col("table").isin(*M.METADATA_KINDS))
    return (m.groupBy(F.col("table").alias("table_name"), "table_type")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_files")))


@register("table_names_by_position", M_CTE + f"""
, parts AS (SELECT string_split(replace(name, '_pub', ''), '.') AS p FROM m)
SELECT DISTINCT tbl AS table_name FROM (
  SELECT unnest(p) AS tbl FROM parts
) x WHERE tbl IN (SELECT tableName FROM ({KNOWN_TABLES_SQL}) k)
UNION
SELECT tbl FROM (
  SELECT CASE WHEN len(p) = 4 THEN p[3] WHEN len(p) IN (10, 11) THEN p[7]
              WHEN len(p) = 12 THEN p[11] WHEN len(p) = 14 THEN p[10] END AS tbl FROM parts
) y WHERE tbl IS NOT NULL
""")
def q_table_names_by_position(spark, sf_dir):
    known = shape(spark, sf_dir, KNOWN_TABLES_SQL)
    return M.table_names_by_position(manifest(spark, sf_dir), known).withColumnRenamed("table", "table_name")


@register("filter_sites", M_CTE + f"""
SELECT path, site FROM m WHERE site IN (SELECT site FROM ({REQUEST_SITES_SQL}) r)
""")
def q_filter_sites(spark, sf_dir):
    sites = shape(spark, sf_dir, REQUEST_SITES_SQL)
    return M.filter_sites(manifest(spark, sf_dir), sites).select("path", "site")


@register("filter_months", M_CTE + """
SELECT path, month FROM m WHERE month IS NULL OR (month >= '1996-03' AND month <= '1998-11')
""")
def q_filter_months(spark, sf_dir):
    return M.filter_months(manifest(spark, sf_dir), "1996-03", "1998-11").select("path", "month")


@register("filter_release", M_CTE + """
SELECT path, release FROM m WHERE release IS NULL OR release <> 'PROVISIONAL'
""")
def q_filter_release(spark, sf_dir):
    return M.filter_release(manifest(spark, sf_dir), "current").select("path", "release")


@register("filter_package", M_CTE + """
, x AS (SELECT *, CASE WHEN max(CASE WHEN package = 'expanded' THEN 1 ELSE 0 END)
                        OVER (PARTITION BY site, month) = 1 THEN 'expanded' ELSE 'basic' END AS chosen FROM m)
, y AS (SELECT *, max(CASE WHEN package = chosen THEN 1 ELSE 0 END) OVER (PARTITION BY site, month) AS has_c FROM x)
SELECT path, package FROM y WHERE has_c = 0 OR package = chosen
""")
def q_filter_package(spark, sf_dir):
    return M.filter_package(manifest(spark, sf_dir), "expanded").select("path", "package")


@register("filter_time_index", M_CTE + """
SELECT path, name FROM m
WHERE NOT contains(name, 'min') OR contains(name, '30min') OR contains(name, '30_min')
""")
def q_filter_time_index(spark, sf_dir):
    return M.filter_time_index(manifest(spark, sf_dir), 30).select("path", "name")


_META_LIST = "['variables', 'readme', 'validation', 'categoricalCodes', 'sensor_positions', 'science_review_flags']"


@register("filter_table", M_CTE + f"""
SELECT path, name FROM m
WHERE contains(name, '.ord_openSummary.') OR contains(name, '.ord_openSummary_pub.')
   OR list_has_any(string_split(name, '.'), {_META_LIST})
""")
def q_filter_table(spark, sf_dir):
    return M.filter_table(manifest(spark, sf_dir), "ord_openSummary", metadata=True).select("path", "name")


@register("filter_position", M_CTE + """
SELECT path, hor, ver FROM m WHERE hor IS NULL OR (hor = '001' AND ver = '020')
""")
def q_filter_position(spark, sf_dir):
    return M.filter_position(manifest(spark, sf_dir), "001", "020").select("path", "hor", "ver")


@register("latest_publication", M_CTE + """
SELECT table_name, site, path, publication AS latest_stamp FROM m
QUALIFY row_number() OVER (PARTITION BY table_name, site ORDER BY publication DESC, path ASC) = 1
""")
def q_latest_publication(spark, sf_dir):
    out = M.latest_publication(manifest(spark, sf_dir), ["table", "site"])
    return _out(out, "table_name", "site", "path", "latest_stamp")


@register("latest_publication_global", M_CTE + """
SELECT path, publication AS latest_stamp FROM m ORDER BY publication DESC, path ASC LIMIT 1
""")
def q_latest_publication_global(spark, sf_dir):
    # a top-1 is the feature here: the newest file of the whole store
    return M.latest_publication(manifest(spark, sf_dir), []).select("path", "latest_stamp")


@register("select_files_by_type", M_CTE + """
SELECT path, table_name, table_type FROM m WHERE table_type = 'site-date'
UNION ALL
SELECT path, table_name, table_type FROM m WHERE table_type IN ('site-all', 'lab')
QUALIFY row_number() OVER (PARTITION BY table_name, CASE WHEN table_type = 'lab' THEN lab ELSE site END
                           ORDER BY publication DESC, path ASC) = 1
""")
def q_select_files_by_type(spark, sf_dir):
    return _out(M.select_files_by_type(manifest(spark, sf_dir)), "path", "table_name", "table_type")


@register("as_of_publication", M_CTE + """
, f AS (SELECT * FROM m WHERE publication IS NULL OR publication <= '20230630T000000Z')
, k AS (SELECT *, (table_name IS NOT NULL AND site IS NOT NULL AND month IS NOT NULL
                   AND publication IS NOT NULL) AS keyed FROM f)
SELECT path FROM k WHERE keyed
QUALIFY rank() OVER (PARTITION BY table_name, site, month ORDER BY publication DESC) = 1
UNION ALL
SELECT path FROM k WHERE NOT keyed
""")
def q_as_of_publication(spark, sf_dir):
    return M.as_of_publication(manifest(spark, sf_dir), "2023-06-30", check=True).select("path")


@register("dedupe_file_versions", M_CTE + """
SELECT regexp_replace(name, '[0-9]{8}T[0-9]{6}Z', '') AS stem, name, path FROM m
QUALIFY row_number() OVER (PARTITION BY regexp_replace(name, '[0-9]{8}T[0-9]{6}Z', '')
                           ORDER BY name DESC, path DESC) = 1
""")
def q_dedupe_file_versions(spark, sf_dir):
    out = M.dedupe_file_versions(manifest(spark, sf_dir))
    stem = F.regexp_replace(F.col("name"), M.N.STAMP_PATTERN, "")
    return out.select(stem.alias("stem"), "name", "path")


@register("attach_variables_file", M_CTE + """
, v AS (SELECT release, site, month, min(path) AS variables_path, min(md5) AS variables_md5
        FROM m WHERE contains(name, '.variables.') GROUP BY 1, 2, 3 HAVING count(*) = 1)
SELECT m.file_id, m.path, v.variables_path, v.variables_md5
FROM m LEFT JOIN v ON m.release = v.release AND m.site = v.site AND m.month = v.month
WHERE NOT contains(m.name, '.variables.')
""")
def q_attach_variables_file(spark, sf_dir):
    return M.attach_variables_file(manifest(spark, sf_dir)).select(
        "file_id", "path", "variables_path", "variables_md5")


@register("match_variables_by_publication", M_CTE + """
, v AS (SELECT product, publication AS vstamp, min(path) AS vpath FROM m
        WHERE contains(name, '.variables.') GROUP BY 1, 2)
, d AS (SELECT file_id, product, path, publication FROM m WHERE NOT contains(name, '.variables.'))
, c AS (SELECT d.*, v.vpath, v.vstamp,
          abs(epoch(strptime(v.vstamp, '%Y%m%dT%H%M%SZ')) - epoch(strptime(d.publication, '%Y%m%dT%H%M%SZ'))) AS gap
        FROM d LEFT JOIN v ON d.product = v.product)
SELECT file_id, path, vpath AS variables_path, vstamp AS variables_publication FROM c
QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY gap ASC, vstamp ASC) = 1
""")
def q_match_variables_by_publication(spark, sf_dir):
    man = manifest(spark, sf_dir)
    is_var = F.col("name").contains(".variables.")
    out = M.match_variables_by_publication(man.filter(~is_var), man.filter(is_var))
    return out.select("file_id", "path", "variables_path", "variables_publication")


@register("table_package_status", M_CTE + f"""
, v AS ({PKG_VARIABLES_SQL})
SELECT tbl AS table_name,
  CASE WHEN bool_and(downloadPkg = 'none') THEN 'none'
       WHEN bool_and(downloadPkg IN ('basic', 'none')) THEN 'basic'
       WHEN bool_and(downloadPkg IN ('expanded', 'none')) THEN 'expanded'
       ELSE 'both' END AS package_status
FROM v GROUP BY tbl
""")
def q_table_package_status(spark, sf_dir):
    man = manifest(spark, sf_dir)
    return M.table_package_status(_pkg_variables(man)).withColumnRenamed("table", "table_name")


def _pkg_variables(man: DataFrame) -> DataFrame:
    t = F.col("table")
    return man.filter(t.isNotNull()).select(
        t.alias("table"),
        F.when(t == "ord_openSummary", "basic").when(t == "ord_labPending", "expanded")
        .otherwise(F.col("package")).alias("downloadPkg"),
    )


@register("tables_in_package", M_CTE + f"""
, v AS ({PKG_VARIABLES_SQL})
, s AS (SELECT tbl,
          CASE WHEN bool_and(downloadPkg = 'none') THEN 'none'
               WHEN bool_and(downloadPkg IN ('basic', 'none')) THEN 'basic'
               WHEN bool_and(downloadPkg IN ('expanded', 'none')) THEN 'expanded'
               ELSE 'both' END AS st FROM v GROUP BY tbl)
, meta AS (SELECT path FROM m WHERE list_has_any(string_split(name, '.'), {_META_LIST}))
SELECT m.path FROM m JOIN s ON m.table_name = s.tbl
WHERE s.st IN ('basic', 'both') AND NOT (s.st = 'both' AND m.package = 'expanded')
  AND NOT list_has_any(string_split(m.name, '.'), {_META_LIST})
UNION ALL SELECT path FROM meta
""")
def q_tables_in_package(spark, sf_dir):
    man = manifest(spark, sf_dir)
    status = M.table_package_status(_pkg_variables(man))
    return M.tables_in_package(man, status, "basic").select("path")


@register("missing_tables", M_CTE + f"""
SELECT tbl AS table_name FROM ({EXPECTED_TABLES_SQL}) e
WHERE tbl NOT IN (SELECT table_name FROM m WHERE table_name IS NOT NULL)
""")
def q_missing_tables(spark, sf_dir):
    expected = shape(spark, sf_dir, EXPECTED_TABLES_SQL).withColumnRenamed("tbl", "table")
    return M.missing_tables(expected, manifest(spark, sf_dir)).withColumnRenamed("table", "table_name")


@register("redirect_sites", f"""
WITH r AS ({REQUEST_SITES_SQL}), l AS ({SHARED_SITES_SQL})
SELECT DISTINCT r.site AS requested_site, coalesce(l.towerSite, r.site) AS site
FROM r LEFT JOIN l ON r.site = l.site AND l.product = 'DP1.00001.001'
""")
def q_redirect_sites(spark, sf_dir):
    req = shape(spark, sf_dir, REQUEST_SITES_SQL)
    lookup = shape(spark, sf_dir, SHARED_SITES_SQL)
    return M.redirect_sites(req, lookup, "DP1.00001.001", "RELEASE-2024")


@register("redirect_flight_sites", f"""
WITH r AS ({REQUEST_SITES_SQL}), l AS ({FLIGHT_SITES_SQL})
SELECT r.site, coalesce(l.flightSite, r.site) AS flight_site FROM r LEFT JOIN l ON r.site = l.site
""")
def q_redirect_flight_sites(spark, sf_dir):
    req = shape(spark, sf_dir, REQUEST_SITES_SQL)
    return M.redirect_flight_sites(req, shape(spark, sf_dir, FLIGHT_SITES_SQL))


@register("resolve_bundles", f"""
WITH p AS ({PRODUCTS_SQL}), c AS ({CHEM_BUNDLES_SQL}), o AS ({OTHER_BUNDLES_SQL})
SELECT p.product,
  CASE WHEN coalesce(c.homeProduct, o.homeProduct) IS NULL THEN 'ok'
       WHEN coalesce(c.homeProduct, o.homeProduct) = 'depends' THEN 'ambiguous' ELSE 'moved' END AS status,
  CASE WHEN coalesce(c.homeProduct, o.homeProduct) IS NULL THEN p.product
       WHEN coalesce(c.homeProduct, o.homeProduct) = 'depends' THEN NULL
       ELSE coalesce(c.homeProduct, o.homeProduct) END AS home_product
FROM p LEFT JOIN c ON p.product = c.product LEFT JOIN o ON p.product = o.product
""")
def q_resolve_bundles(spark, sf_dir):
    return M.resolve_bundles(
        shape(spark, sf_dir, PRODUCTS_SQL),
        shape(spark, sf_dir, CHEM_BUNDLES_SQL),
        shape(spark, sf_dir, OTHER_BUNDLES_SQL),
        "RELEASE-2024",
    )


_SIZE_TEXT = """
CASE WHEN total_bytes / 1e6 < 1000 THEN
       (CASE WHEN total_bytes / 1e6 = floor(total_bytes / 1e6) THEN cast(cast(floor(total_bytes / 1e6) AS bigint) AS varchar)
             ELSE cast(total_bytes / 1e6 AS varchar) END) || ' MB'
     ELSE (CASE WHEN total_bytes / 1e9 = floor(total_bytes / 1e9) THEN cast(cast(floor(total_bytes / 1e9) AS bigint) AS varchar)
             ELSE cast(total_bytes / 1e9 AS varchar) END) || ' GB' END AS size_text
"""


@register("download_size", M_CTE + f"""
SELECT site, total_bytes, {_SIZE_TEXT} FROM (
  SELECT site, cast(coalesce(sum(size), 0) AS bigint) AS total_bytes FROM m GROUP BY site) t
""")
def q_download_size(spark, sf_dir):
    return M.download_size(manifest(spark, sf_dir), ["site"])


@register("latest_metadata_files", M_CTE + """
(SELECT path FROM m WHERE contains(name, '.readme.') ORDER BY publication DESC, path ASC LIMIT 1)
UNION ALL
(SELECT path FROM m WHERE contains(name, '.sensor_positions.')
 QUALIFY row_number() OVER (PARTITION BY site ORDER BY publication DESC, path ASC) = 1)
UNION ALL
SELECT path FROM m WHERE contains(name, '.variables.')
UNION ALL
SELECT path FROM m WHERE contains(name, '.science_review_flags.')
""")
def q_latest_metadata_files(spark, sf_dir):
    return M.latest_metadata_files(manifest(spark, sf_dir)).select("path")


@register("validate_product_id", M_CTE + """
SELECT cast(count(DISTINCT product) AS bigint) AS n_products,
       cast(count(DISTINCT CASE WHEN NOT regexp_matches(product, '^DP[1-4]\\.[0-9]{5}\\.00[1-2]$') THEN product END) AS bigint) AS n_invalid,
       CASE WHEN max(CASE WHEN package = 'expanded' THEN 1 ELSE 0 END) = 1 THEN 'expanded' ELSE 'basic' END AS package
FROM m
""")
def q_validate_product_id(spark, sf_dir):
    return M.product_id_check(manifest(spark, sf_dir))


# One request: three sites, two of them served by another, in its tower's place
# what that one published; of the table asked for the data, and the newest
# metadata beside it.
_REQUESTED_SQL = "SELECT site FROM (VALUES ('ST03'), ('ST12'), ('ST17'), ('ST24')) v(site)"
_PRODUCT = "DP1.00001.001"


@register("select_product_files", M_CTE + f"""
, req AS ({_REQUESTED_SQL}), l AS ({SHARED_SITES_SQL})
, served AS (SELECT DISTINCT req.site AS asked, coalesce(l.towerSite, req.site) AS site
             FROM req LEFT JOIN l ON l.site = req.site AND l.product = '{_PRODUCT}')
, f0 AS (SELECT * FROM m WHERE product = '{_PRODUCT}' AND site IN (SELECT site FROM served)
         AND month BETWEEN '1994-01' AND '1997-12' AND release <> 'PROVISIONAL')
, f1 AS (SELECT *, bool_or(package = 'basic') OVER (PARTITION BY site, month) AS has_basic FROM f0)
, f AS (SELECT *, list_has_any(string_split(name, '.'), {_META_LIST}) AS meta FROM f1 WHERE NOT has_basic OR package = 'basic')
, chosen AS (
  SELECT path, site, size, 'data' AS role FROM f WHERE NOT meta AND contains(name, '.ord_fulfilled.')
  UNION ALL (SELECT path, site, size, 'readme' FROM f WHERE contains(name, '.readme.') ORDER BY publication DESC, path LIMIT 1)
  UNION ALL (SELECT path, site, size, 'sensor_positions' FROM f WHERE contains(name, '.sensor_positions.')
             QUALIFY row_number() OVER (PARTITION BY site ORDER BY publication DESC, path) = 1)
  UNION ALL SELECT path, site, size, 'variables' FROM f WHERE contains(name, '.variables.')
  UNION ALL SELECT path, site, size, 'science_review_flags' FROM f WHERE contains(name, '.science_review_flags.'))
, total AS (SELECT cast(coalesce(sum(size), 0) AS bigint) AS total_bytes FROM chosen)
, by_site AS (SELECT site, string_agg(asked, ',' ORDER BY asked) AS requested_sites FROM served GROUP BY site)
SELECT path, role, requested_sites, 'ok' AS bundle_status, '{_PRODUCT}' AS home_product, total_bytes, {_SIZE_TEXT}
FROM chosen JOIN by_site USING (site), total
""")
def q_select_product_files(spark, sf_dir):
    from ..plans import query as Q

    files = Q.select_product_files(
        manifest(spark, sf_dir), _PRODUCT, sites=shape(spark, sf_dir, _REQUESTED_SQL), start="1994-01", end="1997-12", table="ord_fulfilled",
        shared_sites=shape(spark, sf_dir, SHARED_SITES_SQL), chem_bundles=shape(spark, sf_dir, CHEM_BUNDLES_SQL), other_bundles=shape(spark, sf_dir, OTHER_BUNDLES_SQL),
    )
    return files.select("path", "role", "requested_sites", "bundle_status", "home_product", "total_bytes", "size_text")
