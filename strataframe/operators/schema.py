"""Schema operators (S1-S12): types declared by ``variables`` metadata.

A ``StructType`` and the casts of one table collect that table's fields; of
variables tables of any size, ``collect=False`` gives the same schema as rows.
Data tables are never collected.  Casts are applied *by column name* with
``try_cast``/``try_to_timestamp``; a failed cast is observed while the typed
table is written (S9) rather than silently becoming null.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..functions.types import STRING_TYPES, spark_type, spark_type_name
from ..session import hinted, scratch_path, write_once

VARIABLE_COLUMNS = ("table", "fieldName", "description", "dataType", "units",
                    "downloadPkg", "pubFormat", "primaryKey", "categoricalCodeName")
POSITION_FIELDS = ("domainID", "siteID", "horizontalPosition", "verticalPosition")
STRING_FIELDS = ("horizontalPosition", "verticalPosition", "publicationDate", "release", "file")


def _declared(variables: DataFrame, table: str | None, package: str | None) -> DataFrame:
    v = variables
    if table is not None:
        v = v.filter(F.col("table") == table)
    if package == "basic":
        v = v.filter(F.col("downloadPkg") == "basic")
    return v


def _rows_for(variables: DataFrame, table: str | None, package: str | None) -> list:
    v = _declared(variables, table, package)
    if "row_no" in v.columns:
        v = v.orderBy("row_no")
    return v.select("fieldName", "dataType", "pubFormat").collect()


def numbered(df: DataFrame, order: Sequence[str], name: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the place of each row, from 1, in ``order`` (nulls first)
    within ``by``, as int ``name``.

    No task holds more than its share of the rows, however large a group: they
    are range-partitioned and sorted, written with their task and their place in
    it, and a row for each task and group says how many came before."""
    by = list(by)
    placed = df.orderBy(*by, *order).withColumn("_id", F.monotonically_increasing_id())
    # the id holds the task's number above 33 bits for the place in the task
    placed = placed.withColumn("_task", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")
    written = write_once(placed, "numbered")
    shares = written.groupBy("_task", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    shares = shares.select(F.col("_task").alias("_t"), *[F.col(c).alias(f"_by_{c}") for c in by], "_first", "_before")
    same = F.col("_task") == F.col("_t")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    place = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return written.join(hinted(shares, 64), same).select(*df.columns, place.cast("int").alias(name))


def declared_fields(variables: DataFrame, table: str | None, package: str | None) -> DataFrame:
    """The fields of a schema as ``(position, fieldName, dataType, pubFormat)``:
    of rows that repeat a name the first counts, and a row without one fails."""
    v = _declared(variables, table, package)
    row_no = F.col("row_no") if "row_no" in v.columns else F.monotonically_increasing_id()
    named = F.coalesce("fieldName", F.raise_error(F.lit("a row of the variables table names no field")).cast("string"))
    first = v.select(named.alias("fieldName"), F.struct(row_no.alias("row_no"), "dataType", "pubFormat").alias("r")).groupBy("fieldName").agg(F.min("r").alias("r"))
    rows = first.select("r.row_no", "fieldName", "r.dataType", "r.pubFormat")
    return numbered(rows, ["row_no", "fieldName"], "position").select("position", "fieldName", "dataType", "pubFormat")


def schema_from_variables(variables: DataFrame, table: str | None = None, package: str | None = "basic",
                          *, collect: bool = True) -> T.StructType | DataFrame | None:
    """``StructType`` in metadata row order; the publication format of a
    field is kept in its metadata.  None when the table has no rows.  With
    ``collect=False`` the same schema as rows (:func:`declared_fields`, and the
    ``type``), none of which reach the driver."""
    if not collect:
        return declared_fields(variables, table, package).withColumn("type", spark_type_name(F.col("dataType"), F.col("pubFormat")))
    rows = _rows_for(variables, table, package)
    if not rows:
        return None
    fields = []
    seen = set()
    for r in rows:
        if r["fieldName"] in seen:
            continue
        seen.add(r["fieldName"])
        fields.append(T.StructField(
            r["fieldName"], spark_type(r["dataType"], r["pubFormat"]), True,
            {"dataType": r["dataType"] or "", "pubFormat": r["pubFormat"] or ""},
        ))
    return T.StructType(fields)


def schema_table(schema: T.StructType | DataFrame) -> list[tuple[int, str, str]] | DataFrame:
    """(position, field, type) rows of a schema, for display; of one that is
    rows already, a frame of them."""
    if isinstance(schema, DataFrame):
        return schema.select("position", F.col("fieldName").alias("field"), "type")
    return [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]


def string_schema(variables_or_names, *, collect: bool = True) -> T.StructType | DataFrame:
    """S3: every field a string (from a variables frame or a name list).  Of a
    frame, ``collect=False`` gives the schema as rows, as in S1."""
    if not collect:
        return declared_fields(variables_or_names, None, None).withColumn("type", F.lit(T.StringType().simpleString()))
    if isinstance(variables_or_names, DataFrame):
        names = [r["fieldName"] for r in _rows_for(variables_or_names, None, None)]
    else:
        names = list(variables_or_names)
    out, seen = [], set()
    for n in names:
        if n not in seen:
            seen.add(n)
            out.append(T.StructField(n, T.StringType(), True))
    return T.StructType(out)


def variables_differ(a: DataFrame, b: DataFrame, table: str) -> bool:
    """Do two variables tables describe ``table`` differently (row count,
    field names or data types)?"""
    cols = ["fieldName", "dataType"]
    x = a.filter(F.col("table") == table).select(*cols)
    y = b.filter(F.col("table") == table).select(*cols)
    return variables_difference(x, y).agg(F.count(F.lit(1))).collect()[0][0] > 0


def variables_difference(x: DataFrame, y: DataFrame) -> DataFrame:
    """Rows in one side and not the other (multiset, both ways), with a side flag."""
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(
        y.exceptAll(x).withColumn("side", F.lit("right")))


class Cell(NamedTuple):
    """A column of a strictly typed table: its text, and the same read as its
    declared type (None: it is text)."""

    name: str
    text: Column
    typed: Column | None = None


def null_tokens(c: Column) -> Column:
    """The text of a cell; blank cells and ``NA`` are null."""
    s = c.cast("string")
    return F.when(s.isNull() | (F.trim(s) == "") | (s == "NA"), F.lit(None)).otherwise(s)


def cast_column(c: Column, field: T.StructField) -> Column:
    """Cast a text column to a declared field (null for unparseable text)."""
    text = null_tokens(c)
    dt = field.dataType
    fmt = (field.metadata or {}).get("pubFormat") or None
    if isinstance(dt, T.StringType):
        return text
    if isinstance(dt, (T.TimestampType, T.DateType)) or (fmt and (field.metadata or {}).get("dataType") == "dateTime"):
        return times.parse_pub_format(text, fmt)
    return F.trim(text).try_cast(dt)


def declared_cell(field: T.StructField) -> Cell:
    """A text column and its reading by a declared field of the same name."""
    c = F.col(f"`{field.name}`")
    return Cell(field.name, null_tokens(c), None if isinstance(field.dataType, T.StringType) else cast_column(c, field))


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column the schema names; others stay as they are."""
    by_name = {f.name: f for f in schema.fields}
    return df.select(*[
        cast_column(F.col(c), by_name[c]).alias(c) if c in by_name else F.col(c)
        for c in df.columns
    ])


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per declared column, the number of non-null cells whose cast
    failed (column ``bad_<name>``)."""
    by_name = {f.name: f for f in schema.fields}
    aggs = []
    for c in df.columns:
        f = by_name.get(c)
        if f is None or isinstance(f.dataType, T.StringType):
            continue
        raw = null_tokens(F.col(c))
        aggs.append(F.count_if(raw.isNotNull() & cast_column(F.col(c), f).isNull()).alias(f"bad_{c}"))
    if not aggs:
        return df.sparkSession.range(1).select(F.lit(0).alias("bad_none"))
    return df.agg(*aggs)


FAULTS = "_faults"


def write_strict(df: DataFrame, cells: Sequence[Cell], finish: Callable[[DataFrame], DataFrame] = lambda d: d) -> tuple[DataFrame, bool]:
    """S9 in one pass: the typed ``cells`` of ``df``, with what ``finish`` makes
    of them, are written under the shared folder together with the names of the
    cells of each row that failed their type, and the write itself observes
    whether there was any.  If none, the written table is the result; else a
    warning, and the table as text (only then ``df`` is read a second time)."""
    failed = [F.when(c.typed.isNull() & c.text.isNotNull(), F.lit(c.name)) for c in cells if c.typed is not None]
    texts = [c.text.alias(c.name) for c in cells]
    if not failed:
        return finish(df.select(*texts)), True
    faults = F.array_compact(F.array(*failed)).alias(FAULTS)
    typed = finish(df.select(*[(c.text if c.typed is None else c.typed).alias(c.name) for c in cells], faults))
    seen = Observation()
    path = scratch_path(df.sparkSession, "typed")
    typed.observe(seen, F.max(F.size(FAULTS)).alias("most")).write.parquet(path)
    written = df.sparkSession.read.schema(typed.schema).parquet(path)
    if (seen.get["most"] or 0) == 0:
        return written.drop(FAULTS), True
    bad = sorted(r[0] for r in written.select(F.explode(FAULTS)).distinct().collect())
    warnings.warn(f"cells failed their declared type in {bad}; table kept as text", stacklevel=3)
    return finish(df.select(*texts)), False


def strict_cast_or_strings(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, bool]:
    """The typed table when every non-null cell casts; else the string
    table and a warning.  Columns that ``schema`` lacks stay as they are.  The
    input is read once, and a second time only for the string table."""
    by_name = {f.name: f for f in schema.fields}
    return write_strict(df, [declared_cell(by_name[c]) if c in by_name else Cell(c, F.col(f"`{c}`")) for c in df.columns])


def field_classes(variables: DataFrame, table: str | None = None) -> DataFrame:
    """(fieldName, class) with ``numeric`` for real/integer types and
    ``character`` for everything else (dates included), of one ``table`` or of
    all; a field that tables type differently is ``character``."""
    if table is not None:
        variables = variables.filter(F.col("table") == table)
    numeric = F.col("dataType").isin("real", "integer", "unsigned integer", "signed integer")
    return variables.groupBy("fieldName").agg(F.when(F.bool_and(F.coalesce(numeric, F.lit(False))), "numeric").otherwise("character").alias("class"))


def cast_by_class(df: DataFrame, variables: DataFrame, table: str | None = None) -> DataFrame:
    """Cast only the fields present: numeric to double, others to text."""
    classes = {r["fieldName"]: r["class"] for r in field_classes(variables, table).collect()}
    return df.select(*[
        (F.trim(null_tokens(F.col(c))).try_cast("double") if classes.get(c) == "numeric"
         else (null_tokens(F.col(c)) if c in classes else F.col(c))).alias(c)
        for c in df.columns
    ])


def parse_dates_first_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, the first of second/minute/hour/day formats that
    parses at least one value is used for the whole column; a column no
    format fits stays text.

    The rows are written under the shared folder, and the write observes which
    formats fit; so the input is read once, and what is read again to be parsed
    is the written table."""
    columns = list(columns)
    if not columns:
        return df
    fits = [
        F.bool_or(parsed.isNotNull()).alias(f"{i}:{label}")
        for i, c in enumerate(columns) for label, parsed in times.parse_first_fit_candidates(F.col(f"`{c}`"))
    ]
    seen = Observation()
    path = scratch_path(df.sparkSession, "dates")
    df.observe(seen, *fits).write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    chosen = {}
    for i, c in enumerate(columns):
        for label, fmt, width in times.FIRST_FIT_FORMATS:
            if seen.get[f"{i}:{label}"]:
                chosen[c] = (fmt, width)
                break
    return written.select(*[
        times.parse_prefix(F.col(f"`{c}`"), *chosen[c]).alias(c) if c in chosen else F.col(f"`{c}`")
        for c in written.columns
    ])


def cast_by_variables(df: DataFrame, variables: DataFrame) -> DataFrame:
    """Type a text table by its variables, by field name (first match).

    real/integer -> double, string/uri -> text, dateTime -> S8 first fit;
    fields the metadata lacks stay text; position columns stay text.
    Raises when the metadata misses required columns or matches no field."""
    missing = [c for c in ("table", "fieldName", "dataType") if c not in variables.columns]
    if missing:
        raise ValueError(f"variables table lacks {missing}")
    rows = variables.select("fieldName", "dataType").collect()
    types: dict[str, str] = {}
    for r in rows:
        types.setdefault(r["fieldName"], r["dataType"])
    present = [c for c in df.columns if c in types]
    if not present:
        raise ValueError("no field of the table is described by the variables table")
    out = []
    dates = []
    for c in df.columns:
        t = types.get(c)
        if c in STRING_FIELDS or t is None or t in STRING_TYPES:
            out.append(null_tokens(F.col(c)).alias(c) if t is not None else F.col(c))
        elif t in ("real", "integer", "unsigned integer", "signed integer"):
            out.append(F.trim(null_tokens(F.col(c))).try_cast("double").alias(c))
        elif t == "dateTime":
            out.append(null_tokens(F.col(c)).alias(c))
            dates.append(c)
        else:
            out.append(null_tokens(F.col(c)).alias(c))
    return parse_dates_first_fit(df.select(*out), dates)


def extend_variables(variables: DataFrame, added_fields: DataFrame, *, with_position: bool) -> DataFrame:
    """For every table, position rows first (when the data has them),
    then the table's own rows, then the provenance rows.

    ``added_fields`` is the user's helper table (fieldName, description,
    dataType, units, downloadPkg, pubFormat, primaryKey,
    categoricalCodeName); its position rows are the ones naming
    ``POSITION_FIELDS``.  Every table gets the same few added rows, so they are
    one array that each table's row explodes.  ``row_no`` gives the order."""
    names = [c for c in added_fields.columns if c != "table"]
    rows = added_fields.select(*names).collect()  # a handful
    wanted = [r for r in rows if with_position or r["fieldName"] not in POSITION_FIELDS]
    cols = [c for c in variables.columns if c != "row_no"]
    own_order = F.col("row_no") if "row_no" in variables.columns else F.monotonically_increasing_id()
    base = variables.select(*cols, F.struct(F.lit(1).alias("rank"), own_order.cast("long").alias("sub")).alias("_place"))
    if wanted:
        literals = [
            F.struct(
                F.lit(0 if r["fieldName"] in POSITION_FIELDS else 2).alias("_rank"), F.lit(i).cast("long").alias("_sub"),
                *[F.lit(r[c]).cast("string").alias(c) for c in names if c in cols],
            )
            for i, r in enumerate(wanted)
        ]
        each = variables.select("table").distinct().select("table", F.explode(F.array(*literals)).alias("r"))
        extra = each.select("table", *[F.col(f"r.{c}").alias(c) for c in names if c in cols],
                            F.struct(F.col("r._rank").alias("rank"), F.col("r._sub").alias("sub")).alias("_place"))
        base = base.unionByName(extra, allowMissingColumns=True)
    return numbered(base, ["_place.rank", "_place.sub"], "row_no", ["table"]).drop("_place")


def patch_variables(variables: DataFrame, extra_rows: DataFrame, table: str, present: bool) -> DataFrame:
    """Add a metadata table's rows when its files exist but the
    variables table lacks them."""
    if not present:
        return variables
    has = variables.filter(F.col("table") == table)
    missing = extra_rows.filter(F.col("table") == table).join(has.select("fieldName"), "fieldName", "left_anti")
    return variables.unionByName(missing, allowMissingColumns=True)


def split_by_table(variables: DataFrame) -> dict[str, DataFrame]:
    """One variables frame per table (table names collected)."""
    names = [r["table"] for r in variables.select("table").distinct().collect()]
    return {t: variables.filter(F.col("table") == t) for t in sorted(n for n in names if n is not None)}


GEOCSV_SEPARATOR = ", "


def geocsv_lines(df: DataFrame, variables: DataFrame, *, title: str | None = None, attribution: str | None = None) -> DataFrame:
    """The GeoCSV header in order, as (line_no, line): data set, delimiter,
    title and attribution if given, and long names, types and units of the
    columns.

    Units missing -> ``unitless``; unsigned/signed integer -> integer, real
    -> float, the rest string."""
    spark = df.sparkSession
    cols = spark.createDataFrame([(i, c) for i, c in enumerate(df.columns)], "pos int, fieldName string")
    # of a field that several tables have, the first table's row
    picked = F.min_by(F.struct("description", "units", "dataType"), F.struct("table", "description"))
    v = variables.groupBy("fieldName").agg(picked.alias("r")).select("fieldName", "r.*")
    gtype = (
        F.when(F.col("dataType").isin("unsigned integer", "signed integer", "integer"), "integer")
        .when(F.col("dataType") == "real", "float").otherwise("string")
    )
    joined = cols.join(v, "fieldName", "left").select(
        "pos",
        F.coalesce(F.col("description"), F.col("fieldName")).alias("long_name"),
        gtype.alias("gtype"),
        F.coalesce(F.nullif(F.nullif(F.col("units"), F.lit("")), F.lit("NA")), F.lit("unitless")).alias("unit"),
    )
    packed = joined.agg(F.array_sort(F.collect_list(F.struct("pos", "long_name", "gtype", "unit"))).alias("c"))
    said = [F.lit("# dataset: GeoCSV 2.0"), F.lit('# delimiter: ","')]
    said += [F.lit(f"# {k}: {v}") for k, v in (("title", title), ("attribution", attribution)) if v is not None]
    said += [
        F.concat(F.lit(f"# {k}: "), F.concat_ws(GEOCSV_SEPARATOR, F.col(f"c.{c}")))
        for k, c in (("field_long_name", "long_name"), ("field_type", "gtype"), ("field_unit", "unit"))
    ]
    return packed.select(F.posexplode(F.array(*said)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def write_geocsv(df: DataFrame, variables: DataFrame, path: str, *, title: str | None = None, attribution: str | None = None) -> str:
    """``df`` as GeoCSV text files under ``path``: the first part file holds
    the header and the column names, the others the rows, nulls as ``NA``."""
    names = df.sparkSession.createDataFrame([(",".join(df.columns),)], "line string")
    head = geocsv_lines(df, variables, title=title, attribution=attribution).orderBy("line_no").select("line")
    cells = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.to_csv(cells, {"nullValue": "NA", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}).alias("line"))
    # a union keeps its sides' order, and so do the part files
    head.coalesce(1).union(names).coalesce(1).union(rows).write.mode("overwrite").text(path)
    return path


def unpivot_uris(tables: dict[str, DataFrame], variables: DataFrame) -> DataFrame:
    """(table, fieldName, uri) of every distinct non-empty value of the
    fields whose declared type is ``uri``.  Raises when no table has one."""
    declared = variables.filter(F.col("dataType") == "uri").select("table", "fieldName").distinct().collect()
    parts = []
    for r in declared:
        df = tables.get(r["table"])
        if df is not None and r["fieldName"] in df.columns:
            parts.append(df.select(F.lit(r["table"]).alias("table"), F.lit(r["fieldName"]).alias("fieldName"),
                                   null_tokens(F.col(r["fieldName"])).alias("uri")))
    if not parts:
        raise ValueError("no table has a field of type uri")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("uri").isNotNull()).distinct()
