"""Readers and writers for survey tables.

Everything is a lazy ``spark.read`` with an explicit schema, so Catalyst
can prune columns and push filters into the parquet scan.  Writers produce
directories of part files (one per task); nothing passes through the driver.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estuary.config import SurveyConfig
from estuary.functions.rsem import num_sql, q
from estuary.sources import schemas


# files of a year, at most; tasks that write one
YEAR_FILES = 8


def _ci_glob(ext: str) -> str:
    """File glob matching an extension in any letter case: csv -> *.[cC][sS][vV]."""
    return "*." + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in ext)


# what a read that counts lost values adds to: table -> one observation for each read of it
Lost = dict[str, list[Observation]]


def typed(raw: DataFrame, schema: T.StructType, optional: Iterable[str] = schemas.OPTIONAL,
          lost: list[Observation] | None = None) -> DataFrame:
    """``raw`` with the declared columns, found by name, in their declared types.

    Columns of the right type are left alone, so filters still reach the
    scan; texts that are no number and values out of range become NULL, and a
    FLOAT goes through its decimal text, so a stored
    0.2 still equals 0.2.  Columns beyond the schema are passed on unchanged.
    A missing optional column is NULL; any other missing column is an error.

    With ``lost`` the values that become NULL are counted while the rows pass
    by (no scan of their own): an observation is added to the list, unless no
    column has to be converted.  Filters then stay above the count.
    """
    kinds = dict(raw.dtypes)
    missing = [f.name for f in schema.fields if f.name not in kinds]
    if gone := [n for n in missing if n not in set(optional)]:
        raise ValueError(f"columns {gone} are missing; the table has {raw.columns}")

    def value(f: T.StructField) -> str:
        name, have, want = q(f.name), kinds.get(f.name), f.dataType.simpleString()
        if have is None:
            return f"CAST(NULL AS {want})"
        if have == want:
            return name
        if want == "string":
            return f"CAST({name} AS STRING)"
        number = num_sql(name) if have in ("string", "float") else f"try_cast({name} AS DOUBLE)"
        if have == "float":
            number = num_sql(f"CAST({name} AS STRING)")
        return f"try_cast({number} AS {want})"

    converted = [f for f in schema.fields if f.name in kinds and f.dataType.simpleString() not in ("string", kinds[f.name])]
    if lost is not None and converted:
        seen = Observation(f"lost-{uuid.uuid4().hex}")
        raw = raw.observe(seen, *(F.expr(f"count_if({value(f)} IS NULL AND trim(CAST({q(f.name)} AS STRING)) <> '')").alias(f.name) for f in converted))
        lost.append(seen)
    declared = set(schema.names)
    return raw.selectExpr(*(f"{value(f)} AS {q(f.name)}" for f in schema.fields), *(q(c) for c in raw.columns if c not in declared))


def lost_values(lost: Lost) -> dict[str, dict[str, int]]:
    """Table -> column -> values lost, once the tables have been read; columns that lost none are left out."""
    out = {}
    for name, seen in lost.items():
        counts = Counter()
        for one in seen:
            counts.update(one.get)
        if found := {c: n for c, n in counts.items() if n}:
            out[name] = found
    return out


def unreadable(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each declared column, how many values its type cannot hold."""
    present = T.StructType([f for f in schema.fields if f.name in raw.columns])
    names = present.names
    both = typed(raw.select(*(F.col(n) for n in names), *(F.col(n).alias("raw " + n) for n in names)), present)
    return both.agg(*(F.count_if(F.col(q(n)).isNull() & (F.trim(F.col(q("raw " + n)).cast("string")) != "")).alias(n) for n in names))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", lost: list[Observation] | None = None) -> DataFrame:
    """Read one table (a file or a directory of part files), by column name."""
    if fmt == "csv":
        return read_survey_csv(spark, path, schema, lost)
    raw = spark.read.format(fmt).load(path)
    return raw if schema is None else typed(raw, schema, lost=lost)


def load_tables(spark: SparkSession, root: str | list[str], fmt: str = "parquet",
                names: Iterable[str] | None = None,
                files: dict[str, str] | None = None, lost: Lost | None = None) -> dict[str, DataFrame]:
    """Load the named survey tables from ``root/<stem>.<fmt>``.

    ``root`` may be a list (e.g. previous-year and current-year folders):
    each table is then one scan over all of them -- Spark lists the files
    of every folder and splits them into tasks together; parquet merges
    schemas, so a column missing in older years reads as NULL.  ``files``
    overrides the file stem per logical name.  In either format columns are
    found by name and brought to their declared types (see ``typed``); with
    ``lost``, a dictionary to fill, lost values are counted on the way.
    """
    roots = [root] if isinstance(root, str) else list(root)
    files = files or {}
    out = {}
    for name in (names or schemas.TABLES):
        stem, schema = schemas.TABLES[name]
        stem = files.get(name, stem)
        seen = None if lost is None else lost.setdefault(name, [])
        paths = [f"{r.rstrip('/')}/{stem}.{fmt}" for r in roots]
        if len(paths) == 1:
            out[name] = read_table(spark, paths[0], schema, fmt, seen)
        elif fmt == "parquet":
            out[name] = typed(spark.read.option("mergeSchema", "true").parquet(*paths), schema, lost=seen)
        else:
            out[name] = union_all(read_table(spark, p, schema, fmt, seen) for p in paths)
    return out


def load_dir(spark: SparkSession, root: str, ext: str = "parquet",
             schema: T.StructType | str | None = None, recursive: bool = False,
             lost: list[Observation] | None = None) -> DataFrame:
    """Read every file under ``root`` whose extension matches ``ext`` in any case, by column name.

    CSV files may order their columns differently: they are grouped by their
    header line, each group is one scan that is read by its own header, and the groups
    are stacked by name.  Without a schema a column that some files lack is
    NULL there.  The headers are read when the plan is built, one line a file.
    """
    fmt = ext.lower()
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"pathGlobFilter": _ci_glob(ext), "recursiveFileLookup": str(recursive).lower()}
    if fmt != "csv":
        if fmt == "parquet":
            options["mergeSchema"] = "true"
        raw = spark.read.format(fmt).options(**options).load(root)
        return raw if schema is None else typed(raw, schema, lost=lost)
    groups = defaultdict(list)
    for row in spark.read.format("binaryFile").options(**options).load(root).select("path").sort("path").collect():
        groups[tuple(spark.read.option("header", "true").csv(row.path).columns)].append(row.path)
    if not groups:
        raise FileNotFoundError(f"no {_ci_glob(ext)} file under {root}")
    return union_all(read_survey_csv(spark, paths, schema, lost) for paths in groups.values())


def read_survey_csv(spark: SparkSession, path: str | list[str],
                    schema: T.StructType | None = None, lost: list[Observation] | None = None) -> DataFrame:
    """Headed CSV with "NA" as the missing-value marker.

    The file's own header names the columns, whatever their order; files of
    one read must agree on it, else it fails (see ``load_dir`` for folders
    of differing files).  With a schema the
    declared columns get their types; all others stay text.  A quoted empty
    value is an empty text, not a missing one.
    """
    raw = (spark.read.option("header", "true").option("nullValue", "NA")
           .option("enforceSchema", "false").option("mode", "FAILFAST").csv(path))
    return raw if schema is None else typed(raw, schema, lost=lost)


def write_survey_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV: NULL is written as NA, an empty text as a quoted empty value.

    A directory of part files.  CSV has no mark that would tell a text that
    is itself "NA" from a missing one; such a text reads back as missing, so
    whatever is to be read again is kept as parquet.
    """
    (df.write.mode(mode).option("header", "true").option("nullValue", "NA")
       .option("emptyValue", '""').csv(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Iterable[str] = ()) -> None:
    """Parquet sink; ``partition_by`` (e.g. ``year``) enables partition pruning on read."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_years(df: DataFrame, path: str, year: str = "year") -> None:
    """Parquet by year: the years that ``df`` holds replace themselves, all others stay.

    Run again for one year, or with one more, this leaves the files of every
    other year untouched; a run that is repeated changes nothing.  Rows are
    dealt by year and a hash of the row, so a year is a few files and a
    large one no single task."""
    spread = F.pmod(F.xxhash64(*(F.col(q(c)) for c in df.columns)), F.lit(YEAR_FILES))
    (df.repartition(F.col(q(year)), spread).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path))


def append_years(prev: DataFrame | None, cur: DataFrame, include_prev: bool = True) -> DataFrame:
    """Stack previous-year data under current-year data, optionally.

    Columns are matched by name; a column missing on one side is NULL there.
    A pure union: no shuffle.
    """
    if prev is None or not include_prev:
        return cur
    return prev.unionByName(cur, allowMissingColumns=True)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def output_name(cfg: SurveyConfig, suffix: str, ext: str = "csv") -> str:
    """Export file name from bay and sampling type, e.g. ``tbm_c.csv``."""
    return f"{(cfg.bay or 'all').lower()}{(cfg.sampling_type or 'all').lower()}_{suffix}.{ext}"
