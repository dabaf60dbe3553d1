"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
FLOATING = ("float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, dtype in df.dtypes if is_numeric(dtype)]


def name(column: str) -> Column:
    """A column by its plain name, whatever characters the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def missing(column: str, dtype: str) -> Column:
    """True where a value is null, or NaN in a floating column."""
    c = name(column)
    return c.isNull() | F.isnan(c) if dtype in FLOATING else c.isNull()


def double_sql(column: str) -> str:
    quoted = column.replace("`", "``")
    return f"nanvl(cast(`{quoted}` AS double), CAST(NULL AS double))"


def as_double(column: str) -> Column:
    """The column as double with NaN turned into null."""
    return F.expr(double_sql(column))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value from here on; applied at every source."""
    return df.select(
        *[
            F.when(~F.isnan(name(c)), name(c)).alias(c) if dtype in FLOATING else name(c)
            for c, dtype in df.dtypes
        ]
    )


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Rows `(ids..., feature, value)` of the non-missing values of `columns`."""
    wide = df.select(*[name(c) for c in ids], *[as_double(c).alias(c) for c in columns])
    long = wide.unpivot([name(c) for c in ids], [name(c) for c in columns], "feature", "value")
    return long.where(F.col("value").isNotNull())


def require(df: DataFrame, columns: Sequence[str]) -> None:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"features not in the input: {absent}")
