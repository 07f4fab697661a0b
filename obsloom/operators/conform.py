"""Bring a frame to declared columns and types; every operator here is one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsloom.functions import parsing

SIMPLE_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def columns(text: str) -> T.StructType:
    """A schema from ``name type, ...``, usable before there is a session."""
    parts = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, SIMPLE_TYPES[kind]) for name, kind in parts])


def family(data_type: T.DataType) -> str:
    """numeric, categorical (text or truth value), time, or other."""
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.StringType, T.BooleanType)):
        return "categorical"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "other"


def columns_of(df: DataFrame, wanted: str) -> list[str]:
    return [f.name for f in df.schema.fields if family(f.dataType) == wanted]


def feature_columns(
    df: DataFrame, exclude: Iterable[str] = (), exclude_suffixes: Sequence[str] = ()
) -> list[str]:
    """Numeric columns without the named ones and without the given endings."""
    barred = set(exclude)
    endings = tuple(exclude_suffixes)
    return [c for c in columns_of(df, "numeric") if c not in barred and not (endings and c.endswith(endings))]


def numeric_and(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Numeric columns, then the targets that exist and are not numeric."""
    numeric = columns_of(df, "numeric")
    return df.select(*numeric, *[t for t in targets if t in df.columns and t not in numeric])


def convert(value: Column, current: T.DataType, data_type: T.DataType) -> Column:
    """Tolerant cast to ``data_type``; only text needs to be read."""
    if isinstance(current, T.StringType) or isinstance(data_type, T.BooleanType):
        return typed(value, data_type)
    return value.try_cast(data_type)


def typed(value: Column, data_type: T.DataType) -> Column:
    """Tolerant cast of text to ``data_type``."""
    if isinstance(data_type, T.BooleanType):
        return parsing.to_boolean(value)
    if isinstance(data_type, T.IntegralType):
        return parsing.to_int(value, data_type.simpleString())
    return value.try_cast(data_type)


def conform(df: DataFrame, schema: T.StructType, digits: Mapping[str, int] | None = None) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    A column that is missing becomes a NULL of its type; a value that cannot be read becomes NULL.
    ``digits`` names the doubles to round.
    """
    digits = digits or {}
    current = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        if field.name not in current:
            column = F.lit(None).cast(field.dataType)
        elif current[field.name] == field.dataType:
            column = F.col(field.name)
        else:
            column = convert(F.col(field.name), current[field.name], field.dataType)
        if field.name in digits:
            column = F.round(column, digits[field.name])
        out.append(column.alias(field.name))
    return df.select(*out)


def cast_columns(df: DataFrame, columns: Sequence[str], data_type: str = "double", digits: int | None = None) -> DataFrame:
    """Tolerant cast of the listed columns that exist."""
    changed = {}
    for name in columns:
        if name in df.columns:
            whole = data_type in ("int", "bigint")
            column = parsing.to_int(F.col(name), data_type) if whole else F.col(name).try_cast(data_type)
            changed[name] = column if digits is None else F.round(column, digits)
    return df.withColumns(changed) if changed else df


def widen_numeric(df: DataFrame) -> DataFrame:
    """Every numeric column as double."""
    numeric = set(columns_of(df, "numeric"))
    return df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])


def with_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are absent as NULLs of the given type."""
    absent = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def mirror_column(df: DataFrame, one: str, other: str) -> DataFrame:
    """When only one of two columns exists, the other becomes its copy."""
    if one in df.columns and other not in df.columns:
        return df.withColumn(other, F.col(one))
    if other in df.columns and one not in df.columns:
        return df.withColumn(one, F.col(other))
    return df


def first_present(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate that is a column of ``df``."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of the columns {', '.join(candidates)} exists")


def coalesce_columns(df: DataFrame, candidates: Sequence[str], out: str) -> DataFrame:
    """The first candidate with a value, row by row; at least one candidate must exist."""
    first_present(df, candidates)
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in candidates if c in df.columns]))


def fill_with(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """Fill NULLs of a column from an expression; a column that is absent is the expression."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), value) if name in df.columns else value for name, value in derived.items()}
    )


def drop_and_rename(df: DataFrame, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Drop columns, present or not, then rename."""
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill absent columns and NULLs from a map of defaults."""
    out = {}
    for name, value in defaults.items():
        out[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    return df.withColumns(out)


def numeric_text_columns(df: DataFrame, max_failed: float = 0.2) -> DataFrame:
    """For every text column: non-null values, values that are no number, and is it numeric?

    Numeric means that fewer than ``max_failed`` of its non-null values fail. One aggregate serves
    all columns: ``column, non_null, failed, is_numeric``.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        raise ValueError("there is no text column")
    counts = []
    for name in text:
        counts.append(F.count(F.col(name)).alias(f"{name}__seen"))
        counts.append(F.count(F.col(name).try_cast("double")).alias(f"{name}__read"))
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"{name}__seen").alias("non_null"),
            (F.col(f"{name}__seen") - F.col(f"{name}__read")).alias("failed"),
        )
        for name in text
    ]
    rows = df.agg(*counts).select(F.inline(F.array(*entries)))
    share = F.col("failed") / F.when(F.col("non_null") > 0, F.col("non_null"))
    return rows.withColumn("is_numeric", F.coalesce(share < F.lit(max_failed), F.lit(False)))


def infer_numeric(df: DataFrame, max_failed: float = 0.2) -> DataFrame:
    """Cast the text columns that :func:`numeric_text_columns` calls numeric (one small job)."""
    verdicts = numeric_text_columns(df, max_failed).where("is_numeric").select("column").collect()
    return cast_columns(df, [row["column"] for row in verdicts])
