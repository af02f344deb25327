"""Row cleaning, enrichment and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar
from millrace.operators import ordered, profile
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.timeseries import date_parts


def derived_column(df: DataFrame, name: str, expression: str | Column) -> DataFrame:
    """Add a column from an SQL expression or a Column."""
    return df.withColumn(name, F.expr(expression) if isinstance(expression, str) else expression)


def remove_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def standardize_dates(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd", source: str | None = None) -> DataFrame:
    return df.withColumns({c: scalar.standard_date(c, fmt, source) for c in columns})


def apply_rules(df: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """Apply configured rules in order: derived_column, remove_nulls, date_format."""
    for rule in rules:
        kind = rule.get("type")
        if kind == "derived_column":
            df = derived_column(df, rule["output_column"], rule["expression"])
        elif kind == "remove_nulls":
            df = remove_nulls(df, rule["columns"])
        elif kind == "date_format":
            columns = rule.get("columns") or [f.name for f in df.schema if f.name.endswith("date")]
            df = standardize_dates(df, columns, rule.get("format", "yyyy-MM-dd"), rule.get("source"))
        else:
            raise ValueError(f"unknown rule type: {kind}")
    return df


def complete_distinct_rows(df: DataFrame, date_column: str | None = None) -> DataFrame:
    """Rows without NULLs, once each, with year, month and day of the date."""
    out = df.dropna().dropDuplicates()
    if date_column is None:
        return out
    parts = date_parts(out, date_column).drop("quarter", "day_of_week", "week_of_year")
    return parts.withColumn("day", F.dayofmonth(date_column))


def require_rows(df: DataFrame) -> DataFrame:
    """Fail if there is nothing to go on with."""
    if df.isEmpty():
        raise ValueError("No data after transformation")
    return df


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None, keep_by: Sequence[Column] | None = None) -> DataFrame:
    """Drop duplicate rows; ``keep_by`` says which copy of a key is first."""
    if keep_by is None:
        return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()
    w = Window.partitionBy(*columns).orderBy(*keep_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def impute(
    df: DataFrame, columns: Sequence[str], method: str = "mean", order_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Fill missing numbers by mean, median or the last earlier value."""
    columns = list(columns)
    if method == "ffill":
        return ordered.forward_fill(df, list(order_by), columns, partition_by)
    if method == "mean":
        stats = df.agg(F.struct(*[F.avg(profile.known(c).cast("double")).alias(c) for c in columns]).alias("s")).scalar()
        fill = {c: stats[c] for c in columns}
    elif method == "median":
        rows = exact_quantiles(df, columns, [0.5]).select("column_name", "q0").collect()
        fill = {r.column_name: F.lit(r.q0) for r in rows}
    else:
        raise ValueError(f"unknown imputation method: {method}")
    return df.withColumns(
        {c: F.coalesce(profile.known(c).cast("double"), fill.get(c, F.lit(None))) for c in columns}
    )


def clean_data(df: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = (), method: str = "mean") -> DataFrame:
    """Drop exact duplicates, lower and trim text, fill missing numbers."""
    out = df.withColumns({c: F.lower(F.trim(c)) for c in text}) if text else df
    out = out.dropDuplicates()
    return impute(out, numeric, method) if numeric else out


def iqr_filter(df: DataFrame, columns: Sequence[str], factor: float = 1.5, sequential: bool = False) -> DataFrame:
    """Drop rows outside the quartile fences of any column, then incomplete rows.

    ``sequential`` computes the fences of each column on the rows that the
    columns before it left over; the default takes one pass over all rows.
    """
    steps = [[c] for c in columns] if sequential else [list(columns)]
    for group in steps:
        fences = profile.fence_values(profile.iqr_fences(df, group, factor))
        for c in group:
            if c in fences:
                lo, hi = fences[c]
                df = df.filter((F.col(c) >= lo) & (F.col(c) <= hi))
            else:
                df = df.filter(F.lit(False))
    return df.dropna()


def iqr_clip(df: DataFrame, columns: Sequence[str], factor: float = 1.5, flag: bool = False) -> DataFrame:
    """Pull values to the nearer fence; ``flag`` adds ``<col>_outlier`` instead."""
    fences = profile.fence_values(profile.iqr_fences(df, columns, factor))
    # A column without values has no fences, and no value outside of them.
    out = {f"{c}_outlier": F.lit(None).cast("boolean") for c in columns if flag and c not in fences}
    for c, (lo, hi) in fences.items():
        if flag:
            out[f"{c}_outlier"] = (F.col(c) < lo) | (F.col(c) > hi)
        else:
            out[c] = F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo)))
    return df.withColumns(out) if out else df


def missing_fields(required: Sequence[str]) -> Column:
    """Names of the required fields a row lacks."""
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return F.filter(names, lambda n: n.isNotNull())


def align_columns(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Exactly these columns in this order; absent ones are filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def hash_sample(df: DataFrame, key: Sequence[str] | str, percent: int) -> DataFrame:
    """The same share of rows on every run, chosen by key."""
    return df.filter(scalar.stable_bucket(key, 100) < percent)


def every_nth(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.filter(F.col(column) % n == 0)


def _list_sizes(value: Column, dtype: T.DataType, path: tuple):
    """For every list in a nested value, by path, an array of the sizes it has in a row."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _list_sizes(value.getField(f.name), f.dataType, (*path, f.name))
    elif isinstance(dtype, T.ArrayType):
        yield path, F.array(F.size(value))
        inner = (*path, "*")

        def sizes_at(below: tuple) -> Column:
            return F.flatten(F.transform(value, lambda x: dict(_list_sizes(x, dtype.elementType, inner))[below]))

        for below, _ in _list_sizes(F.lit(None), dtype.elementType, inner):
            yield below, sizes_at(below)


def _list_widths(df: DataFrame) -> dict[tuple, int]:
    """Longest list of every path, from one pass over the lists alone."""
    sizes = [x for f in df.schema.fields for x in _list_sizes(F.col(f"`{f.name}`"), f.dataType, (f.name,))]
    if not sizes:
        return {}
    row = df.agg(*[F.max(F.array_max(c)).alias(f"w{i}") for i, (_, c) in enumerate(sizes)]).first()
    return {path: max(0, row[i] or 0) for i, (path, _) in enumerate(sizes)}


def flatten(df: DataFrame, sep: str = "_", max_items: int | None = None) -> DataFrame:
    """Nested records to flat columns ``a_b``; list items to ``a_0``, ``a_1`` ...

    Columns are part of a plan: without ``max_items`` a pass over the lists finds how many
    items they have. With it, a row that holds more fails whichever columns are read.
    For lists without a sensible bound use ``flatten_long``.
    """
    widths = None if max_items is not None else _list_widths(df)

    def walk(value: Column, dtype: T.DataType, name: str, path: tuple):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                inner = f"{name}{sep}{f.name}" if name else f.name
                yield from walk(value.getField(f.name), f.dataType, inner, (*path, f.name))
        elif isinstance(dtype, T.ArrayType):
            for i in range(max_items if widths is None else widths[path]):
                yield from walk(F.get(value, i), dtype.elementType, f"{name}{sep}{i}", (*path, "*"))
        else:
            yield value.alias(name)

    if widths is None:
        sizes = [x for f in df.schema.fields for x in _list_sizes(F.col(f"`{f.name}`"), f.dataType, (f.name,))]
        for path, c in sizes:
            name = sep.join(p for p in path if p != "*")
            error = F.raise_error(F.lit(f"{name}: more than {max_items} items")).cast("boolean")
            df = df.where(F.when(F.array_max(c) > max_items, error).otherwise(True))
    cols = [c for f in df.schema.fields for c in walk(F.col(f"`{f.name}`"), f.dataType, f.name, (f.name,))]
    return df.select(*cols)


def flatten_long(df: DataFrame, keys: Sequence[str], sep: str = "_") -> DataFrame:
    """One row per leaf of a nested record: the keys, its ``path`` (``a_0_b``) and its ``value`` as text.

    Lists may have any length. Absent records and empty lists give no rows, NULL leaves do.
    """
    leaf = "array<struct<path: string, value: string>>"

    def walk(value: Column, dtype: T.DataType, path: Column) -> Column:
        if isinstance(dtype, T.StructType):
            parts = [walk(value.getField(f.name), f.dataType, F.concat(path, F.lit(f"{sep}{f.name}"))) for f in dtype.fields]
            return F.when(value.isNotNull(), F.concat(*parts)).otherwise(F.array().cast(leaf))
        if isinstance(dtype, T.ArrayType):
            items = F.transform(value, lambda x, i: walk(x, dtype.elementType, F.concat(path, F.lit(sep), i.cast("string"))))
            return F.coalesce(F.flatten(items), F.array().cast(leaf))
        return F.array(F.struct(path.alias("path"), value.cast("string").alias("value")))

    fields = [f for f in df.schema.fields if f.name not in keys]
    leaves = F.concat(*[walk(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in fields])
    return df.select(*keys, F.inline(leaves))


def deep_merge(base: DataFrame, override: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Override fields of nested records where the other side has a value.

    Records of either side alone stay; NULL keys meet each other; a record that is NULL on
    both sides stays NULL.
    """

    def merge(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
        if isinstance(old_type, T.StructType) and isinstance(new_type, T.StructType):
            new_fields = {f.name: f.dataType for f in new_type.fields}
            parts = []
            for f in old_type.fields:
                if f.name in new_fields:
                    value = merge(old.getField(f.name), new.getField(f.name), f.dataType, new_fields[f.name])
                else:
                    value = old.getField(f.name)
                parts.append(value.alias(f.name))
            parts += [new.getField(n).alias(n) for n in new_fields if n not in old_type.fieldNames()]
            return F.when(old.isNotNull() | new.isNotNull(), F.struct(*parts))
        return F.coalesce(new, old)

    right = override.select(*[F.col(c).alias(f"_new_{c}") for c in override.columns])
    same = [base[k].eqNullSafe(right[f"_new_{k}"]) for k in keys]
    joined = base.join(right, same, "full")
    out = [F.coalesce(F.col(k), F.col(f"_new_{k}")).alias(k) for k in keys]
    for f in base.schema.fields:
        if f.name in keys:
            continue
        if f.name in override.columns:
            new_type = override.schema[f.name].dataType
            out.append(merge(F.col(f.name), F.col(f"_new_{f.name}"), f.dataType, new_type).alias(f.name))
        else:
            out.append(F.col(f.name))
    out += [F.col(f"_new_{c}").alias(c) for c in override.columns if c not in base.columns]
    return joined.select(*out)
