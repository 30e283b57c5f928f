"""Time-series operators (E1-E14) over the *long* series table

    file, site, dataset, timeBgn, timeEnd, stat, value

where ``dataset`` is the hierarchical path ``/site/level/category/system/
[hor_ver_tmi/[subsys/]]name``.  The merge of all variables on the consensus
timestamps is one aggregate and one shuffle: rows that share keys and
``timeBgn`` meet once and give both the consensus ``timeEnd`` and every column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..functions import times
from ..session import hinted, write_once

# Dataset names left out of the consensus timestamps, the
# levels that need no variable filter, and the filler span in seconds.
NON_CONSENSUS = ("qfqm", "turb", "foot")
FLUX_LEVELS = ("dp02", "dp03", "dp04")
FILLER_SECONDS = 86399
ISOTOPE_INTERVAL_SECONDS = 537
ISOTOPE_AVERAGING = 9
CARBON_NAMES = ("dlta13CCo2",)
WATER_NAMES = ("dlta18OH2o", "dlta2HH2o")


def parse_dataset_path(df: DataFrame, col: str = "dataset") -> DataFrame:
    """Site, level, category, system, hor, ver, tmi, name, oth, subsys.

    The last component names the dataset; those before it fill site, level,
    category, system, the position part and subsys from the left, and missing
    ones are null.  The position part is split on ``_`` and aligned at its end,
    so ``010_30m`` has a ``ver`` and a ``tmi`` but no ``hor``; a ``ver`` that is
    no number moves to ``oth``."""
    parts = F.filter(F.split(F.col(col), "/"), lambda p: p != "")
    group = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def part(i: int) -> Column:
        return F.try_element_at(group, F.lit(i))

    # a lacking hor (and ver) is put in front, so that three parts remain
    tokens = F.split(part(5), "_")
    padded = F.concat(F.array_repeat(F.lit(None).cast("string"), F.greatest(3 - F.size(tokens), F.lit(0))), tokens)

    def position(i: int) -> Column:
        return F.when(part(5).isNotNull(), F.try_element_at(padded, F.lit(i)))

    numeric = position(2).try_cast("double").isNotNull()
    return df.select(
        "*",
        part(1).alias("site_part"),
        part(2).alias("level"),
        part(3).alias("category"),
        part(4).alias("system"),
        position(1).alias("hor"),
        F.when(numeric, position(2)).alias("ver"),
        position(3).alias("tmi"),
        F.try_element_at(parts, F.lit(-1)).alias("name"),
        F.when(~numeric, position(2)).alias("oth"),
        part(6).alias("subsys"),
    )


def filter_series(df: DataFrame, level: str, var: Sequence[str] | None = None, avg: int | str | None = None) -> DataFrame:
    """Keep one level; for levels other than dp02-dp04 keep variables
    matching ``var`` and averaging ``<avg>m``; dp01 needs ``avg``; footprint
    grids never stay.  Each file decides for itself: if ``var`` names systems
    and datasets of it, both must match, else the kind that it names; a file
    that has neither fails the query when it runs.  Expects the columns of
    :func:`parse_dataset_path`."""
    if level == "dp01" and avg is None:
        raise ValueError("level dp01 needs avg")
    ds = F.col("dataset")
    cond = ds.contains(level) & ~ds.contains("foot/grid")
    out = df
    if level not in FLUX_LEVELS:
        if avg is not None:
            cond = cond & ds.contains(f"{avg}m")
        if var:
            in_sys, in_name = F.col("system").isin(list(var)), F.col("name").isin(list(var))
            named = (
                df.groupBy(F.col("file").alias("_file"))
                .agg(F.coalesce(F.bool_or(in_sys), F.lit(False)).alias("_sys"), F.coalesce(F.bool_or(in_name), F.lit(False)).alias("_name"))
            )
            out = df.join(named, F.col("file").eqNullSafe(F.col("_file")))
            nothing = F.raise_error(F.concat(F.lit(f"no dataset matches {list(var)} in "), F.coalesce("file", F.lit("a file without a name"))))
            match = F.when(F.col("_sys") & F.col("_name"), in_sys & in_name).when(F.col("_sys"), in_sys).otherwise(in_name)
            cond = F.when(F.col("_sys") | F.col("_name"), cond & match).otherwise(nothing.cast("boolean"))
    return out.filter(cond).select(*df.columns)


def parse_series_time(df: DataFrame, cols: Sequence[str] = ("timeBgn", "timeEnd")) -> DataFrame:
    """Text stamps to timestamps (fractional seconds, trailing ``Z``);
    the raw text stays in ``<col>_text`` for the flag."""
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_text", F.col(c)).withColumn(c, times.parse_series_time(F.col(c)))
    return out


def time_parse_flags(df: DataFrame, cols: Sequence[str] = ("timeBgn", "timeEnd")) -> DataFrame:
    """E3 flag: per dataset, the number of stamps that failed to parse, and
    whether none parsed at all."""
    aggs = []
    for c in cols:
        failed = F.col(f"{c}_text").isNotNull() & F.col(c).isNull()
        aggs += [F.count_if(failed).cast("bigint").alias(f"{c}_failed"),
                 (F.count_if(F.col(c).isNotNull()) == 0).alias(f"{c}_unparsed")]
    return df.groupBy("dataset").agg(*aggs)


def drop_day_fillers(df: DataFrame) -> DataFrame:
    """Drop rows whose interval spans a day or more."""
    span = F.abs(times.seconds_between(F.col("timeBgn"), F.col("timeEnd")))
    return df.filter(span.isNull() | (span < FILLER_SECONDS))


def _in_consensus() -> Column:
    return ~F.col("dataset").rlike("|".join(NON_CONSENSUS))


def _consensus_end() -> Column:
    """``timeEnd`` of the first dataset in path order that counts."""
    return F.expr("min_by(timeEnd, struct(dataset, timeEnd)) FILTER (WHERE _counts)")


def consensus_timestamps(df: DataFrame, keys: Sequence[str] = ("file", "hor", "ver")) -> DataFrame:
    """E5: per key, the distinct ``timeBgn`` of datasets whose path has no
    ``qfqm``/``turb``/``foot``; ``timeEnd`` from the first dataset in path
    order.  One partial-aggregated shuffle."""
    rows = df.withColumn("_counts", _in_consensus()).filter(F.col("_counts") & F.col("timeBgn").isNotNull())
    return rows.groupBy(*keys, "timeBgn").agg(_consensus_end().alias("timeEnd"))


def series_column(df: DataFrame) -> Column:
    """``category.system.name.stat``; a missing part stays an empty one, so that
    no two variables share a column."""
    return F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("category", "system", "name", "stat")])


def series_columns(df: DataFrame) -> list[str]:
    """Known wide column names (metadata-sized: one per variable and stat)."""
    names = df.select(series_column(df).alias("c")).distinct().collect()
    return sorted(r["c"] for r in names)


def series_dictionary(df: DataFrame) -> DataFrame:
    """The written dictionary of a series table: ``(dataset, stat, _dataset,
    _variable, variable, counts)`` for each dataset and statistic: a number for
    the dataset, in path order, one for the variable, and whether the dataset
    gives consensus times.  Metadata: it doesn't grow with the rows."""
    known = write_once(df.select("dataset", "stat", series_column(df).alias("variable"), _in_consensus().alias("counts")).distinct(), "series-names")
    numbered = {}
    for column, code in (("dataset", "_dataset"), ("variable", "_variable")):
        ordered = known.select(column).distinct().orderBy(column).withColumn(code, F.monotonically_increasing_id())
        numbered[column] = write_once(ordered, "series-codes")
    both = known.join(numbered["dataset"], "dataset").join(numbered["variable"], "variable")
    return write_once(both.select("dataset", "stat", "_dataset", "_variable", "variable", "counts"), "series-dictionary")


def _whole_number(df: DataFrame, column: str) -> Column:
    """An order column as a long, so that aggregates over it need no sort."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    raise ValueError(f"{column} must hold whole numbers, dates or timestamps")


def _series_cells(df: DataFrame, keys: list[str], order_col: str, dictionary: DataFrame) -> DataFrame:
    """The cells of a merge, dealt by (keys, timeBgn): for each time, dataset
    and variable the value and its order, and the end that the dataset gives."""
    names = hinted(dictionary.select(F.col("dataset").alias("_d"), F.col("stat").alias("_s"), "_dataset", "_variable", "counts"), 256)
    rows = df.filter(F.col("timeBgn").isNotNull()).select(
        *keys, "timeBgn", "timeEnd", "dataset", "stat", F.col("value").cast("double").alias("value"), _whole_number(df, order_col).alias("_ord")
    )
    coded = rows.join(names, (F.col("dataset") == F.col("_d")) & F.col("stat").eqNullSafe(F.col("_s")))
    dealt = coded.select(*keys, "timeBgn", "timeEnd", "_dataset", "_variable", "counts", "value", "_ord").repartition(*keys, "timeBgn")
    return dealt.groupBy(*keys, "timeBgn", "_dataset", "_variable", "counts").agg(
        F.min_by("value", "_ord").alias("value"), F.min("_ord").alias("_ord"), F.min("timeEnd").alias("timeEnd")
    )


#: The variable number under which a merge carries the consensus end.
_END = -1


def merge_series_wide(df: DataFrame, *, order_col: str, keys: Sequence[str] = ("file", "hor", "ver"),
                      columns: Sequence[str] | None = None, layout: str = "wide") -> DataFrame:
    """E5 + E6 + E7: every consensus timestamp with its values; values at other
    times are dropped; a repeated (time, variable) keeps the first by
    ``order_col`` (whole numbers, dates or timestamps).  Keys may be null and
    meet as equals.

    Datasets and variables are numbers of a written dictionary, so that one
    shuffle by (keys, timeBgn) carries rows of fixed width and every aggregate
    on them is a hash aggregate.  ``layout="wide"``: one column per
    ``category.system.name.stat`` (those of ``columns``, by default all that
    occur), by a pivot over the numbers, whose work per cell doesn't depend on
    how many columns there are; the consensus end is pivoted with them, as
    microseconds.  ``layout="long"``: the same cells as rows (``variable``,
    ``value``)."""
    if layout not in ("wide", "long"):
        raise ValueError(f"layout is wide or long, not {layout!r}")
    keys = list(keys)
    dictionary = series_dictionary(df)
    cells = _series_cells(df, keys, order_col, dictionary)
    # the end of the first dataset in path order; one without an end still counts
    end = F.coalesce(F.unix_micros("timeEnd").cast("double"), F.lit(float("nan")))
    if layout == "long":
        ends = cells.filter("counts").groupBy(*keys, "timeBgn").agg(F.min_by(end, "_dataset").alias("_end"))
        values = cells.groupBy(*keys, "timeBgn", "_variable").agg(F.min_by("value", "_ord").alias("value"))
        given = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "timeBgn"])], "_end")
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "timeBgn"])])
        names = hinted(dictionary.select(F.col("_variable").alias("_v"), "variable").distinct(), 256)
        met = values.join(given, same).join(names, F.col("_variable") == F.col("_v"))
        return met.select(*keys, "timeBgn", _micros("_end").alias("timeEnd"), "variable", "value")
    named = {r["variable"]: r["_variable"] for r in dictionary.select("variable", "_variable").distinct().collect()}  # the output's columns
    wanted = list(columns) if columns is not None else sorted(named)
    present = [c for c in wanted if c in named]
    here = F.array(F.struct(F.col("_variable").alias("code"), F.col("value").alias("v"), F.col("_ord").alias("o")))
    ended = F.when(F.col("counts"), F.array(F.struct(F.lit(_END).cast("long").alias("code"), end.alias("v"), F.col("_dataset").alias("o"))))
    parts = cells.select(*keys, "timeBgn", F.inline(F.concat(here, F.coalesce(ended, F.array().cast("array<struct<code:bigint,v:double,o:bigint>>")))))
    table = parts.groupBy(*keys, "timeBgn").pivot("code", [_END, *(named[c] for c in present)]).agg(F.min_by("v", "o"))
    values = [F.col(f"`{named[c]}`") if c in named else F.lit(None).cast("double") for c in wanted]
    return table.filter(F.col(f"`{_END}`").isNotNull()).select(
        *keys, "timeBgn", _micros(f"`{_END}`").alias("timeEnd"), *[v.alias(c) for v, c in zip(values, wanted)]
    )


def _micros(column: str) -> Column:
    """Microseconds held as a double back as a timestamp; NaN is null."""
    return F.when(~F.isnan(column), F.timestamp_micros(F.col(column).cast("long")))


def stack_months(frames: Sequence[DataFrame], *, sort: bool = True) -> DataFrame:
    """Union with fill; ordered by HOR, VER, timeBgn when asked."""
    from .stack import union_evolving

    out = union_evolving(frames)
    if sort:
        keys = [c for c in ("hor", "ver", "timeBgn") if c in out.columns]
        out = out.orderBy(*keys)
    return out


def series_variables(df: DataFrame) -> DataFrame:
    """Distinct (category, system, variable, stat, units) of the first
    file (by name)."""
    first = df.agg(F.min("file").alias("_f"))
    units = F.col("units") if "units" in df.columns else F.lit(None).cast("string")
    return (
        df.join(first, F.col("file") == F.col("_f"), "left_semi")
        .select("category", "system", F.col("name").alias("variable"), "stat", units.alias("units"))
        .distinct()
    )


def series_attributes(attrs: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """E10 of a long attribute table (site, date, attr, values array<string>):
    (site, date, attribute...); vectors joined with ``,``."""
    text = F.concat_ws(",", F.col("values"))
    g = attrs.groupBy("site", "date")
    pv = g.pivot("attr", list(names)) if names is not None else g.pivot("attr")
    return pv.agg(F.first(text, ignorenulls=True))


# Fixed value: what marks the datasets whose attributes are a validation's.
VALIDATION_NAME = "rtioMoleDryCo2Vali"


def file_attributes(files: DataFrame, attrs: DataFrame, kind: str, names: Sequence[str] | None = None) -> DataFrame:
    """The attributes of one kind, a row for each of ``files(file, site)``:
    ``site``, ``date`` and a column for each attribute name that any file has
    (those of ``names``, by default all, sorted), null where a file lacks it,
    vectors joined with ``,``.

    ``attrs(file, level, attrs map<string, array<string>>)`` holds what could be
    read: of ``kind`` "site" the level is the file's site, of "root" ``/``, of
    "val" the path of a validation dataset (a file with several gives a row for
    each).  A file without such a level, or that couldn't be read, keeps its
    site and date.  The date is the first month in the name of a basic file,
    the first day in that of any other.  A site that isn't known, a file that
    is listed twice and attributes of unlisted files: a null site, two rows, no
    rows.  One join by file; attributes named like ``site`` or ``date`` get a
    ``_`` in front."""
    if kind not in ("site", "root", "val"):
        raise ValueError(f"kind is site, root or val, not {kind!r}")
    name = F.col("file")
    date = F.when(name.contains("basic"), N.month_of(name)).otherwise(F.nullif(F.regexp_extract(name, "20[0-9]{2}-[0-9]{2}-[0-9]{2}", 0), F.lit("")))
    listed = files.select("file", F.col("site").cast("string").alias("site"), date.alias("date"))
    level = {"site": F.col("level") == F.col("site"), "root": F.col("level") == "/", "val": F.contains("level", F.lit(VALIDATION_NAME))}[kind]
    read = attrs.select(F.col("file").alias("_file"), "level", "attrs")
    met = listed.join(read, (name == F.col("_file")) & level, "left")
    if names is None:
        found = met.select(F.explode(F.map_keys("attrs")).alias("attr")).distinct().collect()  # metadata: the output's columns
        names = sorted(r["attr"] for r in found)

    def cell(attr: str) -> Column:
        values = F.try_element_at("attrs", F.lit(attr))
        return F.when(values.isNotNull(), F.concat_ws(",", values)).alias(f"_{attr}" if attr in ("site", "date") else attr)

    return met.select("site", "date", *[cell(a) for a in names])


#: Rows of a file's merge that its cadence is taken from.
CADENCE_ROWS = 20


def isotope_cadence_files(df: DataFrame, keys: Sequence[str] = ("file", "hor", "ver")) -> DataFrame:
    """E11 by file: whether it holds carbon and water isotopes, and the mean
    length in seconds of the first 20 rows of its merge, which is ordered by
    sensor level and time; fewer rows are all taken, unknown lengths left out.

    Only 20 rows of a file leave each task (the ranking is limited before the
    shuffle), so a file with very many rows is no hot group."""
    names = F.concat_ws(".", "system", "name")
    rows = df.filter(F.col("timeBgn").isNotNull()).withColumns({
        "_counts": _in_consensus(),
        "_c": names.rlike("|".join(CARBON_NAMES)),
        "_w": names.rlike("|".join(WATER_NAMES)),
    })
    kinds = rows.groupBy("file").agg(F.bool_or("_c").alias("has_carbon"), F.bool_or("_w").alias("has_water"))
    levels = [k for k in keys if k != "file"]
    stamps = consensus_timestamps(df, keys)
    order = Window.partitionBy("file").orderBy(*[F.col(k).asc_nulls_first() for k in levels], "timeBgn")
    first = stamps.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= CADENCE_ROWS)
    means = first.groupBy(F.col("file").alias("_file")).agg(F.avg(times.seconds_between("timeBgn", "timeEnd")).alias("mean_interval"))
    return kinds.join(means, F.col("file").eqNullSafe(F.col("_file")), "left").drop("_file")


def isotope_cadence_check(df: DataFrame, avg: int | str = ISOTOPE_AVERAGING) -> DataFrame:
    """One row: isotopes of both kinds present, the shortest mean interval
    (s) of a file's first 20 rows, and the flag: averaging 9, both present, and
    that interval below 537 s (the two are measured at different cadences)."""
    both = F.bool_or("has_carbon") & F.bool_or("has_water")
    gated = F.lit(int(avg) == ISOTOPE_AVERAGING)
    return isotope_cadence_files(df).agg(
        F.bool_or("has_carbon").alias("has_carbon"), F.bool_or("has_water").alias("has_water"),
        F.round(F.min("mean_interval"), 4).alias("min_mean_interval"),
        (gated & both & (F.min("mean_interval") < ISOTOPE_INTERVAL_SECONDS)).alias("flag"),
    )


def releases_in_paths(paths: DataFrame, col: str = "path") -> DataFrame:
    """Distinct path parts naming a release, ``PROVISIONAL`` or ``LATEST``."""
    parts = F.explode(F.split(F.col(col), r"[./]"))
    return (
        paths.select(parts.alias("release"))
        .filter(F.col("release").rlike("RELEASE|PROVISIONAL|LATEST"))
        .distinct()
    )


def package_check(paths: DataFrame, col: str = "path") -> DataFrame:
    """E14 check row: the packages named in the paths."""
    pkg = F.regexp_extract(F.col(col), r"\.(basic|expanded)\.", 1)
    return paths.agg(F.array_join(F.array_sort(F.collect_set(F.nullif(pkg, F.lit("")))), ",").alias("packages"))


def guard_single_package(paths: DataFrame, col: str = "path") -> DataFrame:
    """Raise when basic and expanded files are mixed."""
    pk = package_check(paths, col).collect()[0]["packages"]
    if "," in (pk or ""):
        raise ValueError("basic and expanded files are mixed; stack them separately")
    return paths


def series_review_flags(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of review-flag tables (stamps as text), then the latest
    version per id with ties kept (T13)."""
    from .stack import dedupe_latest_by_id, union_evolving

    nonempty = [f for f in frames if f is not None]
    stamps = ("lastUpdateDateTime", "startDateTime", "endDateTime", "createDateTime")
    texted = [f.select(*[F.col(c).cast("string").alias(c) if c in stamps else F.col(c) for c in f.columns])
              for f in nonempty]
    return dedupe_latest_by_id(union_evolving(texted), keep_ties=True)
