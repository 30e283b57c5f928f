"""Stacking plans (T14-T18): compositions of manifest, scan, schema and
stack operators.  Only file lists, headers and variables tables are collected
while planning; a strictly typed table is parsed and written in one pass.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..functions.types import spark_type
from ..operators import manifest as M
from ..operators import schema as S
from ..operators import stack as ST
from ..session import hinted, write_once
from ..sources import csv as C
from ..sources.catalog import issue_log
from ..sources.listing import scan_manifest


def read_variables(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The newest variables file of ``files`` (a manifest), as strings with
    its row order in ``row_no``."""
    var = files.filter(F.col("name").contains(".variables."))
    newest = M.latest_publication(var, []).select("path").collect()
    if not newest:
        return None
    return read_versions(spark, newest[0]["path"])


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """One variables file as strings, its row order in ``row_no``: a file has a
    row for each published field."""
    df = C.read_csv_group(spark, [path], C.read_header(path))
    return df.withColumn("row_no", F.monotonically_increasing_id()).drop("file")


def version_digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``(path, publication, version)`` of the variables files: the md5 of the
    manifest, or where it has none that of the file's bytes."""
    var = manifest.filter(F.col("name").contains(".variables.")).select("path", "publication", "md5")
    unknown = [r["path"] for r in var.filter("md5 is null").select("path").distinct().collect()]
    if not unknown:
        return var.select("path", "publication", F.col("md5").alias("version"))
    read = spark.read.format("binaryFile").load(unknown).select(N.plain_path("path").alias("_plain"), F.md5("content").alias("_digest"))
    met = var.join(read, N.plain_path("path") == F.col("_plain"), "left")
    return met.select("path", "publication", F.coalesce("md5", "_digest", "path").alias("version"))


def version_fields(spark: SparkSession, files: DataFrame, table: str, package: str) -> list:
    """T5: the fields that each of the variables ``files(path, version)`` gives
    a table, in order: one scan of them all.  A row for each field and version
    is collected, which is metadata."""
    raw = C.scan_csv(spark, files)
    if raw is None:
        return []
    rows = raw.withColumn("row_no", F.monotonically_increasing_id()).filter(F.col("table") == table)
    if package == "basic":
        rows = rows.filter(F.col("downloadPkg") == "basic")
    named = files.select(N.plain_path("path").alias("_path"), "version")
    met = rows.join(named, N.plain_path("file") == F.col("_path"))
    return met.select("version", "row_no", "fieldName", "dataType", "pubFormat").orderBy("version", "row_no").collect()


def version_cells(rows: list, versions: list[str], present: list[str], package: str, version: Column) -> tuple[list[S.Cell], bool]:
    """T5: how each field's cells are read, as one expression over all
    ``versions``: by the number that ``version`` gives a row where versions
    differ in its format, as text where they differ in its type.  In a basic
    table a version that lacks a field leaves it null; an expanded one reads it
    as the others do.  Also whether any cell depends on the version."""
    declared: dict[str, dict[int, T.StructField]] = {}
    for r in rows:
        kind = T.StructField(r["fieldName"], spark_type(r["dataType"], r["pubFormat"]), True, {"dataType": r["dataType"] or "", "pubFormat": r["pubFormat"] or ""})
        declared.setdefault(r["fieldName"], {}).setdefault(versions.index(r["version"]), kind)
    cells, depends = [], False
    for name, by in declared.items():
        if name not in present:
            continue
        kinds: dict[str, tuple[T.StructField, list[int]]] = {}
        for number, kind in by.items():
            kinds.setdefault(kind.json(), (kind, []))[1].append(number)
        (first, _), *others = kinds.values()
        cell = S.declared_cell(first)
        if len({kind.dataType for kind, _ in kinds.values()}) > 1:
            cell = cell._replace(typed=None)
        elif cell.typed is not None and others:
            typed = cell.typed
            for kind, numbers in others:
                typed = F.when(version.isin(numbers), S.declared_cell(kind).typed).otherwise(typed)
            cell, depends = cell._replace(typed=typed), True
        if package == "basic" and len(by) < len(versions):
            here = version.isin(list(by))
            cell = S.Cell(name, F.when(here, cell.text), None if cell.typed is None else F.when(here, cell.typed))
            depends = True
        cells.append(cell)
    return cells, depends


def stack_versions(spark: SparkSession, manifest: DataFrame, table: str, *, package: str = "basic") -> DataFrame | None:
    """T5 + T14: each file of a table typed by the variables file published with
    it (C18).  However many versions of these there are, the plan is one scan:
    versions are data, told apart by content, and a row's version follows from
    its file's product and publication.  A field that versions type differently
    is text; a cell that fails its version's type makes the table text (S9)."""
    files = M.select_files_by_type(manifest.filter(F.col("table") == table))
    kind = table_kind(files, table)
    if kind is None:
        return None
    var = manifest.filter(F.col("name").contains(".variables."))
    digests = version_digests(spark, var).select(F.col("path").alias("variables_path"), "version").distinct()
    matched = M.match_variables_by_publication(files, var).join(digests, "variables_path")
    matched = write_once(matched.withColumn("_stamp", N.publication_stamp(F.col("name"))), "versions")
    raw = C.scan_csv(spark, matched)
    if raw is None:
        return None
    used = matched.groupBy("version").agg(F.min("variables_path").alias("path"))
    versions = sorted(r["version"] for r in used.select("version").collect())
    rows = version_fields(spark, used, table, package)
    present = [c for c in raw.columns if c != "file"]
    cells, depends = version_cells(rows, versions, present, package, F.col("_version"))
    if package != "basic":
        named = {c.name for c in cells}
        cells += [S.Cell(c, F.col(f"`{c}`")) for c in present if c not in named]
    if depends:
        numbers = F.create_map(*[F.lit(x) for i, v in enumerate(versions) for x in (v, i)])
        stamps = matched.select(F.col("product").alias("_product"), "_stamp", numbers[F.col("version")].alias("_version")).distinct()
        name = N.basename(F.col("file"))
        raw = raw.join(hinted(stamps, 128), N.product_of(name).eqNullSafe(F.col("_product")) & (N.publication_stamp(name) == F.col("_stamp")))
    out, _ = S.write_strict(raw, [*cells, S.Cell("file", F.col("file"))], finisher(*kind))
    return out


def table_kind(files: DataFrame, table: str) -> tuple[str, bool] | None:
    """The publication type of a table's files, and whether they carry a
    sensor position; None without files.  Several types raise."""
    info = files.agg(
        F.max(F.col("hor").isNotNull().cast("int")).alias("has_pos"),
        F.array_sort(F.collect_set("table_type")).alias("types"),
    ).first()
    if not info["types"]:
        return None
    if len(info["types"]) > 1:
        raise ValueError(f"files of {table} are of several kinds: {info['types']}")
    return info["types"][0], bool(info["has_pos"])


def finisher(table_type: str, has_position: bool) -> Callable[[DataFrame], DataFrame]:
    """Provenance and position from the file, which then goes."""
    return lambda df: ST.drop_columns(ST.with_position(ST.with_provenance(df), table_type, has_position=has_position), "file")


def stack_table(spark: SparkSession, manifest: DataFrame, table: str, *,
                variables: DataFrame | None = None, package: str = "basic",
                sort: bool = False, strict: bool = True) -> DataFrame | None:
    """Choose files (C14), scan by header (T1), de-duplicate review
    flags (T12), type by the variables schema (S1, ladder S9), add
    provenance (T7) and position (T8), optionally sort (T9), drop ``file``.

    A strict table is written once, typed, while it is parsed, and the result
    reads what was written; with ``strict=False`` it stays a lazy scan in which
    cells that fail their type are null."""
    files = manifest.filter(F.col("table") == table)
    kind = table_kind(files, table)
    if kind is None:
        return None
    raw = C.scan_csv(spark, M.select_files_by_type(files))
    if raw is None:
        warnings.warn(f"no readable file for table {table}", stacklevel=2)
        return None
    if table == "science_review_flags":
        raw = ST.dedupe_latest_by_id(raw)
    schema = S.schema_from_variables(variables, table, package) if variables is not None else None
    finish = finisher(*kind)
    if schema is None:
        out = finish(raw)
    else:
        cells = [S.declared_cell(f) for f in schema.fields if f.name in raw.columns]
        named = {c.name for c in cells}
        # a basic table has the basic fields only; an expanded one shows all
        if package != "basic":
            cells += [S.Cell(c, F.col(f"`{c}`")) for c in raw.columns if c not in named and c != "file"]
        cells.append(S.Cell("file", F.col("file")))
        if strict:
            out, _ = S.write_strict(raw, cells, finish)
        else:
            out = finish(raw.select(*[(c.text if c.typed is None else c.typed).alias(c.name) for c in cells]))
    return ST.order_stacked(out) if sort else out


def table_key(table: str, variables_md5: str | None = None) -> str:
    """Output key of a table: ``2D…`` becomes ``twoD…``."""
    return ("two" + table[1:]) if table.startswith("2D") else table


METADATA_WITH_ROWS = ("science_review_flags", "sensor_positions")


def complete_variables(variables: DataFrame, tables: dict[str, list[str]], manifest: DataFrame,
                       added_fields: DataFrame | None, metadata_variables: DataFrame | None) -> DataFrame:
    """The variables table of a stacked product: the rows of a metadata table
    that has files but no rows (S11, from ``metadata_variables``), and for the
    stacked ``tables`` (name -> columns) the rows of ``added_fields`` for what
    stacking added to each: position first, provenance last (S10)."""
    if metadata_variables is not None:
        present = {r["table"] for r in manifest.select("table").filter(F.col("table").isin(*METADATA_WITH_ROWS)).distinct().collect()}
        for name in METADATA_WITH_ROWS:
            variables = S.patch_variables(variables, metadata_variables, name, name in present)
    if added_fields is None:
        return variables
    parts = []
    positioned = [t for t, columns in tables.items() if "horizontalPosition" in columns]
    plain = [t for t in tables if t not in positioned]
    for names, with_position in ((positioned, True), (plain, False)):
        if names:
            parts.append(S.extend_variables(variables.filter(F.col("table").isin(names)), added_fields, with_position=with_position))
    rest = variables if not tables else variables.filter(~F.coalesce(F.col("table").isin(list(tables)), F.lit(False)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, rest])


def stack_product(spark: SparkSession, source, *, package: str = "basic", sort: bool = False,
                  strict: bool = True, product_code: str | None = None, tables=None,
                  added_fields: DataFrame | None = None, metadata_variables: DataFrame | None = None,
                  catalogue: DataFrame | None = None, check: bool = True) -> dict[str, DataFrame]:
    """The tables of a product folder (or manifest), all or those of
    ``tables``, and its metadata, keys sorted:

    * ``variables``: the newest file, completed by S10 and S11
      (:func:`complete_variables`),
    * ``validation``, ``categoricalCodes`` and ``readme`` (its lines): the newest
      file, where the folder has one,
    * ``issueLog`` (C28) where ``catalogue`` (JSON documents in ``json``) knows
      the product.

    With ``check``, a folder of several products or releases raises (C35, T11)."""
    manifest = write_once(scan_manifest(spark, source), "manifest") if isinstance(source, str) else source
    types = M.table_types(manifest)
    names = sorted(r["table"] for r in types.select("table").collect())
    wanted = names if tables is None else [t for t in names if t in set(tables)]
    variables = read_variables(spark, manifest)
    products = [r["product"] for r in manifest.select("product").filter(F.col("product").isNotNull()).distinct().limit(2).collect()]
    if check:
        if len(products) > 1:
            raise ValueError("the folder holds more than one product; stack them one by one")
        ST.guard_single_release(manifest.filter(F.col("table").isNotNull()))
    code = product_code or (products[0].split(".")[1] if len(products) == 1 else "")
    suffix = f"_{code}" if code else ""
    if variables is not None:
        full = complete_variables(variables, {}, manifest, None, metadata_variables)
    out: dict[str, DataFrame] = {}
    stacked: dict[str, list[str]] = {}
    for t in wanted:
        df = stack_table(spark, manifest, t, variables=None if variables is None else full, package=package, sort=sort, strict=strict)
        if df is None:
            continue
        stacked[t] = df.columns
        out[f"{t}{suffix}" if t in METADATA_WITH_ROWS else table_key(t)] = df
    if variables is not None:
        out[f"variables{suffix}"] = complete_variables(variables, stacked, manifest, added_fields, metadata_variables).drop("row_no")
    for kind in ("validation", "categoricalCodes", "readme"):
        newest = M.latest_publication(manifest.filter(F.col("name").contains(f".{kind}."))).select("path").collect()
        if newest:
            path = newest[0]["path"]
            out[f"{kind}{suffix}"] = spark.read.text(path) if kind == "readme" else read_versions(spark, path).drop("row_no")
    if catalogue is not None and len(products) == 1:
        out[f"issueLog{suffix}"] = issue_log(catalogue).filter(F.col("product") == products[0])
    return dict(sorted(out.items()))


def stack_store(spark: SparkSession, root: str, *, pubdate: str | None = None, package: str = "basic",
                start: str | None = None, end: str | None = None, sites="all", time_index=None, sort: bool = False,
                release: str = "current", include_provisional: bool = False, tables=None, **product) -> dict[str, DataFrame]:
    """The store as of ``pubdate`` (C15), filtered by site, month, release
    and averaging interval (C6-C8, C10), then stacked (T15, with the further
    arguments in ``product``).

    The newest variables file that is as old as ``pubdate`` says which tables a
    package has (C19): the expanded one has all, the basic one those with basic
    fields.  Of a table that both packages have, the asked package's files
    count, and the other's only for site-months not published in it (C20, C9).
    ``missing_tables`` in the result are those the package should have and no
    file was found for (C21), which also warns.  Raises when no variables file
    is as old as ``pubdate``."""
    man = scan_manifest(spark, root)
    man = M.filter_sites(man, sites)
    man = M.filter_months(man, start, end)
    man = M.filter_release(man, release, include_provisional)
    man = M.filter_time_index(man, time_index)
    if pubdate is not None:
        man = M.published_by(man, pubdate, check=True)
    man = write_once(man, "manifest")
    variables = read_variables(spark, man)
    if variables is None:
        found = M.as_of_publication(package_files(man, package), pubdate)
        return stack_product(spark, write_once(found, "manifest"), package=package, sort=sort, tables=tables, check=False, **product)
    status = write_once(M.table_package_status(variables), "package-status")
    # the package first: a newer file of the other one must not hide the asked one's
    kept = M.as_of_publication(M.tables_in_package(man, status, package, fallback=True), pubdate)
    found = write_once(kept, "manifest")
    expected = status if package == "expanded" else status.filter(F.col("package_status").isin("basic", "both"))
    missing = write_once(M.missing_tables(expected, found), "missing")
    names = [r["table"] for r in missing.orderBy("table").collect()]
    if names:
        warnings.warn(f"the {package} package should have tables that no file was found for: {names}", stacklevel=2)
    out = stack_product(spark, found, package=package, sort=sort, tables=tables, check=False, **product)
    return dict(sorted({**out, "missing_tables": missing}.items()))


def package_files(manifest: DataFrame, package: str) -> DataFrame:
    """C9 on the data files: of a site-month (or a table without month) published
    in both packages one counts.  Metadata files stay."""
    data = F.col("table").isNotNull()
    return M.filter_package(manifest.filter(data), package).unionByName(manifest.filter(~data))


def load_table(spark: SparkSession, root: str, table: str, *, sites="all", start: str | None = None,
               end: str | None = None, package: str = "basic", release: str = "current",
               include_provisional: bool = False, time_index=None) -> DataFrame | None:
    """Select files (C6-C11) and stack one table.  A table that the asked
    package doesn't have raises (C19, C20)."""
    man = scan_manifest(spark, root)
    man = M.filter_sites(man, sites)
    man = M.filter_months(man, start, end)
    man = M.filter_release(man, release, include_provisional)
    man = M.filter_time_index(man, time_index)
    man = package_files(man, package)
    man = write_once(M.as_of_publication(man, None), "manifest")
    variables = read_variables(spark, man)
    if variables is not None and package == "basic":
        status = M.table_package_status(variables).filter(F.col("table") == table).select("package_status").first()
        if status is not None and status[0] == "expanded":
            raise ValueError(f"{table} is only in the expanded package")
    return stack_table(spark, man, table, variables=variables, package=package)


def stack_frame_files(spark: SparkSession, files: DataFrame, frame_variables: DataFrame | None,
                      module: str, *, product_prefix: str | None = None) -> DataFrame | None:
    """Per-sample files of one module (with ``product_prefix``, those whose
    names don't start with it): typed by the module's frame variables; if a cell
    fails them, or there are none, by those of ``module2``; else inferred (a
    column that no type fits is text)."""
    per_sample = files if product_prefix is None else files.filter(~F.col("name").startswith(product_prefix))
    raw = C.scan_csv(spark, per_sample)
    if raw is None:
        return None
    for m in (module, module + "2"):
        schema = None if frame_variables is None else S.schema_from_variables(frame_variables, m, None)
        if schema is None:
            continue
        fields = [f for f in schema.fields if f.name in raw.columns]
        named = {f.name for f in fields}
        cells = [S.declared_cell(f) if f.name in named else S.Cell(f.name, F.col(f"`{f.name}`")) for f in fields]
        cells += [S.Cell(c, F.col(f"`{c}`")) for c in raw.columns if c not in named]
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # the next rung says more
            typed, ok = S.write_strict(raw, cells)
        if ok:
            return typed
    warnings.warn(f"no variables fit the files of {module}; their types are inferred", stacklevel=2)
    return C.scan_csv_inferred(spark, per_sample)


# The products with per-sample files, the kind of sequence their
# file names tell apart, and the table that their files make.  A table's prefix
# is its module.
FRAME_RULES = (
    ("DP1.10081.001", "ITS", "mcc_soilPerSampleTaxonomy_ITS"),
    ("DP1.10081.001", "16S", "mcc_soilPerSampleTaxonomy_16S"),
    ("DP1.10081.002", "ITS", "mct_soilPerSampleTaxonomy_ITS"),
    ("DP1.10081.002", "16S", "mct_soilPerSampleTaxonomy_16S"),
    ("DP1.20086.001", "ITS", "mcc_benthicPerSampleTaxonomy_ITS"),
    ("DP1.20086.001", "16S", "mcc_benthicPerSampleTaxonomy_16S"),
    ("DP1.20086.002", "ITS", "mct_benthicPerSampleTaxonomy_ITS"),
    ("DP1.20086.002", "16S", "mct_benthicPerSampleTaxonomy_16S"),
    ("DP1.20141.001", "ITS", "mcc_surfaceWaterPerSampleTaxonomy_ITS"),
    ("DP1.20141.001", "16S", "mcc_surfaceWaterPerSampleTaxonomy_16S"),
    ("DP1.20141.002", "ITS", "mct_surfaceWaterPerSampleTaxonomy_ITS"),
    ("DP1.20141.002", "16S", "mct_surfaceWaterPerSampleTaxonomy_16S"),
    ("DP1.20190.001", None, "rea_conductivityRawData"),
    ("DP1.20193.001", None, "sbd_conductivityRawData"),
    ("DP4.00132.001", None, "bat_processedSonarFile"),
    ("DP1.30012.001", None, "fsp_rawSpectra"),
)


def frame_outputs(files: DataFrame, prefix: str, rules=FRAME_RULES) -> DataFrame:
    """The per-sample files of a manifest (names that don't begin with
    ``prefix``) and the ``output`` table that the rules deal each to, by the
    product of its name or its folder and the kind of sequence in its name.
    Files of other products, and of a kind a product's rules don't name, go."""
    of = files.sparkSession.createDataFrame(list(rules), "_rule_product string, _sequence string, output string")
    sequence = F.nullif(F.regexp_extract("name", "_(ITS|16S)_", 1), F.lit(""))
    product = F.coalesce("product", N.product_of(N.basename(N.dirname(F.col("path")))))
    samples = files.filter(~F.col("name").startswith(prefix)).withColumn("_product", product).withColumn("_kind", sequence)
    met = samples.join(F.broadcast(of), (F.col("_product") == F.col("_rule_product")) & (F.col("_sequence").isNull() | (F.col("_sequence") == F.col("_kind"))))
    return met.drop("_product", "_kind", "_rule_product", "_sequence")


def stack_frames(spark: SparkSession, manifest: DataFrame, frame_variables: DataFrame | None, *, prefix: str, rules=FRAME_RULES) -> dict[str, DataFrame]:
    """The tables of all per-sample files of a manifest, by name: files are
    dealt to their tables in one pass over the manifest, and each table is typed
    by its module's variables, with the ladder of :func:`stack_frame_files`."""
    dealt = write_once(frame_outputs(manifest, prefix, rules), "frames")
    out = {}
    for r in dealt.select("output").distinct().orderBy("output").collect():
        name = r["output"]
        df = stack_frame_files(spark, dealt.filter(F.col("output") == name), frame_variables, name.split("_")[0].upper())
        if df is not None:
            out[name] = df
    return out
