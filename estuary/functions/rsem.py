"""R / dplyr value semantics expressed with built-in Spark expressions.

The survey logic was written against R data frames, whose NA handling
differs from SQL NULL handling in a handful of places.  Each helper here
pins one of those differences so that operators stay one-liners and every
expression stays JVM-side (whole-stage codegen, no Python UDF).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def q(name: str) -> str:
    """Back-quoted column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def names_sql(xs: Iterable) -> str:
    """Literals of an SQL ``IN`` list."""
    return ", ".join(sql_lit(x) for x in xs)


def case_expr(branches: list[tuple[str, str]], otherwise: str = "NULL") -> Column:
    """One ``CASE WHEN .. THEN .. END`` built from SQL text: a single JVM call
    instead of one per sub-expression when chains have dozens of branches."""
    body = " ".join(f"WHEN {cond} THEN {val}" for cond, val in branches)
    return F.expr(f"CASE {body} ELSE {otherwise} END")


def label_at(bits: list[str], known: list[str], labels: dict[tuple[int, ...], str]) -> Column:
    """The label of a pattern of 0/1 texts ``bits``: a place in a constant array, not a chain of CASEs.

    NULL for a pattern without a label, and unless all ``known`` hold."""
    width = len(bits)
    at = " + ".join(f"{b} * {1 << (width - 1 - i)}" for i, b in enumerate(bits))
    patterns = (tuple(n >> (width - 1 - i) & 1 for i in range(width)) for n in range(1 << width))
    listed = ", ".join(sql_lit(labels[p]) if p in labels else "CAST(NULL AS STRING)" for p in patterns)
    return F.expr(f"CASE WHEN {' AND '.join(known)} THEN get(array({listed}), {at}) END")


def num_sql(x: str) -> str:
    """``as.numeric`` of SQL text ``x``: a decimal number, else NULL.

    Spark's cast also reads 'NaN', 'Infinity' and type suffixes ('20d');
    none is a reading of the survey, and one NaN would spoil a haul's sums.
    """
    return f"CASE WHEN NOT CAST({x} AS STRING) RLIKE '[dDfFnNyY]' THEN try_cast({x} AS DOUBLE) END"


def num(x: ColumnOrName) -> Column:
    """``as.numeric``: text to DOUBLE, unparsable text becomes NULL (never an error)."""
    if isinstance(x, str):
        return F.expr(num_sql(q(x)))
    return F.when(~x.cast("string").rlike("[dDfFnNyY]"), x.try_cast("double"))


def r_ifelse(cond: Column, yes, no) -> Column:
    """``ifelse``: a NULL condition gives NULL, not the ``no`` branch."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def in_set(x: ColumnOrName, values: Iterable) -> Column:
    """``x %in% values``: never NULL (NULL input is simply not in the set)."""
    return F.coalesce(c(x).isin(list(values)), F.lit(False))


def not_in_set(x: ColumnOrName, values: Iterable) -> Column:
    return ~in_set(x, values)


def sum0(x: ColumnOrName) -> Column:
    """``sum(x, na.rm = TRUE)``: 0 when every input is NULL or there is none."""
    return F.coalesce(F.sum(c(x)), F.lit(0.0))


def num_text(x: ColumnOrName) -> Column:
    """How R prints a number inside ``paste0``: whole doubles without a
    decimal part (2 -> "2"), others in full; NULL stays NULL here."""
    x = c(x)
    whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def paste0(*parts: ColumnOrName) -> Column:
    """``paste0``: NULL parts become the text "NA" instead of nulling the result."""
    return F.concat(*[F.coalesce(c(p).cast("string"), F.lit("NA")) for p in parts])


def first_of_group(order: Sequence[Column], payload: Column,
                   where: Column | None = None) -> Column:
    """Aggregate for dplyr ``slice(1)`` after ``arrange(order)``.

    ``min`` over a struct compares field by field, so the row with the
    smallest ordering key wins.  Unlike ``row_number()`` over a window this
    is an ordinary aggregate: Spark combines partial minima map-side, so a
    hot group never has to sit in one task.  Rows failing ``where`` are
    skipped; the result is NULL when no row qualifies.
    """
    key = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], payload.alias("payload"))
    if where is not None:
        key = F.when(where, key)
    return F.min(key).getField("payload")


def asc_nulls_last(x: ColumnOrName) -> list[Column]:
    """Ordering fields for ``first_of_group``: ascending, NULL after every value."""
    x = c(x)
    return [x.isNull(), x]


def tail_first(x: str, n: int) -> str:
    """SQL text: text ``x`` with its last ``n`` characters in front; shorter texts stay as they are.

    Equal for equal texts only, as long as before, and sorted faster where
    texts begin alike, as keys of hauls do (bay, type, year): a sort compares
    the first eight bytes, and looks the rows up where these are equal.
    """
    return f"concat(substring({x}, -{n}), substring({x}, 1, length({x}) - {n}))"


def tail_last(x: str, n: int) -> str:
    """SQL text: what ``tail_first`` made, as it was."""
    return f"concat(substring({x}, {n + 1}), substring({x}, 1, {n}))"


def with_order_code(df: DataFrame, x: str, name: str) -> DataFrame:
    """``df`` with a BIGINT that orders as the DOUBLE column ``x`` does, and differs where it differs.

    Sign times (exponent, mantissa): the bits of an IEEE double, made by
    exact arithmetic (scaling by powers of two loses nothing).  The exponent
    that ``log2`` proposes is corrected by comparison.  NULL stays NULL.  One
    projection a step: each is a method short enough to be compiled.
    """
    a, e = q("_abs"), q("_exp")
    df = df.withColumn("_abs", F.expr(f"abs({q(x)})")).withColumn("_guess", F.expr(f"CAST(floor(log2(CASE WHEN {a} < double('infinity') THEN {a} END)) AS INT)"))
    df = df.withColumn("_exp", F.expr(f"_guess + CASE WHEN pow(2D, _guess + 1) <= {a} THEN 1 WHEN pow(2D, _guess) > {a} THEN -1 ELSE 0 END"))
    df = df.withColumn("_bits", F.expr(
        f"CASE WHEN {a} = 0 THEN 0L WHEN {a} = double('infinity') THEN {0x7FF << 52}L "
        f"WHEN {e} < -1022 THEN CAST({a} * {2.0 ** 1000!r}D * {2.0 ** 74!r}D AS BIGINT) "
        f"ELSE ({e} + 1023) * {1 << 52}L + CAST(({a} / pow(2D, {e}) - 1) * {1 << 52}D AS BIGINT) END"))
    return df.withColumn(name, F.expr(f"CASE WHEN {q(x)} < 0 THEN -_bits ELSE _bits END")).drop("_abs", "_guess", "_exp", "_bits")


def resolve(df: DataFrame, *names: str) -> str:
    """Return the first existing column among ``names`` (exact case first,
    then case-insensitive)."""
    cols = df.columns
    for n in names:
        if n in cols:
            return n
    lower = {x.lower(): x for x in cols}
    for n in names:
        if n.lower() in lower:
            return lower[n.lower()]
    raise KeyError(f"none of {names} in {cols}")


def keep_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``select(all_of(names[names %in% names(df)]))``.

    Names are compared case-sensitively, as R does: ``totalshorecover`` does
    not select ``TotalShoreCover``.  Spark resolves names case-insensitively,
    so each physical column is selected at most once.
    """
    present = set(df.columns)
    out, seen = [], set()
    for n in names:
        if n in present and n.lower() not in seen:
            out.append(n)
            seen.add(n.lower())
    return df.selectExpr(*[q(n) for n in out])


def drop_clashing(right: DataFrame, left: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop from ``right`` the non-key columns ``left`` already has (case-insensitive),
    so a join never produces two columns Spark cannot tell apart."""
    keys_l = {k.lower() for k in keys}
    left_l = {x.lower() for x in left.columns}
    cols = right.columns
    keep = [x for x in cols if x.lower() in keys_l or x.lower() not in left_l]
    return right if len(keep) == len(cols) else right.selectExpr(*[q(x) for x in keep])


def pivot_fill(df: DataFrame, key: str | list[str], names: str, value: str,
               values: list[str], fill=0.0) -> DataFrame:
    """``pivot_wider(names_from, values_from, values_fill = fill)`` with an
    explicit column list: one aggregate by the key alone (a ``pivot`` would group by
    key and name first and hold both tables in one task), no job to discover the names, a
    schema fixed at analysis time.  Absent cells get ``fill``; rows whose
    name is NULL or not listed still yield their key row (all filled)."""
    keys = [key] if isinstance(key, str) else list(key)
    cells = [F.max(F.when(F.col(names) == v, F.col(value))).alias(v) for v in values]
    return df.groupBy(*keys).agg(*cells).na.fill(fill, subset=values)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (used only where results are compared across engines)."""
    cols = [f"round({q(f.name)}, {digits}) AS {q(f.name)}" if f.dataType.typeName() == "double"
            else q(f.name) for f in df.schema.fields]
    return df.selectExpr(*cols)
