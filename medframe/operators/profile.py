"""Deep-empty column profiling.

Indicator per column and row: **0 = empty, 1 = has a value**. Null -> 0;
string blank after trimming spaces -> 0; array of size 0 -> 0; struct -> 0
when all its fields are 0, at any depth; anything else non-null -> 1.

``filled_counts`` sums the indicators of every column in one aggregation
(partial sums per partition, one final row: no shuffle of data, one tiny
exchange of one row per partition). ``drop_deep_empty`` reads that one row on
the driver and drops the columns whose count is 0. With zero input rows the
sums are null and every column is kept. With ``materialize=True`` the counts are
observed while the input is written once, and the columns are dropped on reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from medframe.functions.decode import quote_ident


def _indicator(path: str, dt: DataType) -> str:
    if isinstance(dt, StringType):
        cond = f"trim({path}) = ''"
    elif isinstance(dt, ArrayType):
        cond = f"size({path}) = 0"
    elif isinstance(dt, StructType):
        if not dt.fields:
            cond = "true"
        else:
            parts = [_indicator(f"{path}.{quote_ident(f.name)}", f.dataType) for f in dt.fields]
            cond = "(" + " + ".join(parts) + ") = 0"
    else:
        cond = "false"
    return f"(case when {path} is null or {cond} then 0 else 1 end)"


def indicator_exprs(df: DataFrame) -> list[tuple[str, str]]:
    """(column name, SQL indicator expression) per top-level column."""
    return [(f.name, _indicator(quote_ident(f.name), f.dataType)) for f in df.schema.fields]


def is_deep_empty(df: DataFrame) -> DataFrame:
    """One indicator column per input column, same names."""
    return df.selectExpr(*[f"{e} as {quote_ident(n)}" for n, e in indicator_exprs(df)])


def filled_counts(df: DataFrame) -> DataFrame:
    """One row: per column, the number of rows where it has a value."""
    return df.selectExpr(
        *[f"cast(sum({e}) as bigint) as {quote_ident(n)}" for n, e in indicator_exprs(df)]
    )


def deep_empty_columns(df: DataFrame) -> list[str]:
    """Names of the columns that are empty in every row (one small job)."""
    return [n for n, v in zip(df.columns, filled_counts(df).first()) if v is not None and v == 0]


def _without(df: DataFrame, counts: dict) -> DataFrame:
    empty = {n for n, v in counts.items() if v is not None and v == 0}
    return df.select(*[quote_ident(c) for c in df.columns if c not in empty]) if empty else df


def drop_deep_empty(df: DataFrame, materialize: bool = False) -> DataFrame:
    """Drop the columns that are deep-empty in every row.

    The input is read twice (profile, then the caller's action). With
    ``materialize=True`` it runs once: it is written under the checkpoint folder
    (see ``medframe.session.materialize``) while the written rows are counted
    (``observe``), and the result reads the other columns of what was written."""
    if not materialize:
        return _without(df, dict(zip(df.columns, filled_counts(df).first())))
    from medframe.session import materialize as _m

    counted = Observation()
    exprs = [F.expr(f"cast(sum({e}) as bigint)").alias(f"n{i}") for i, (_, e) in enumerate(indicator_exprs(df))]
    written = _m(df.observe(counted, *exprs), "deep-empty")
    got = counted.get
    return _without(written, {n: got[f"n{i}"] for i, n in enumerate(df.columns)})
