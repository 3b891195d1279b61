"""Column expressions for blanks, nulls and dtype-driven column lists."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_of_type(df: DataFrame, data_type: type[T.DataType], exclude: Iterable[str] = ()) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, data_type) and f.name not in skipped]


def nullify(column: str | Column, sentinel: str = " ") -> Column:
    """Null where the value equals the sentinel, else the value unchanged."""
    value = F.col(column) if isinstance(column, str) else column
    return F.nullif(value, F.lit(sentinel))


def not_blank(columns: Sequence[str], trim: bool = False) -> Column:
    """True where no column is '' or ' '. With trim, any run of spaces counts as blank."""
    def filled(name: str) -> Column:
        value = F.col(name)
        return F.trim(value) != "" if trim else (value != " ") & (value != "")

    return reduce(lambda left, right: left & right, map(filled, columns), F.lit(True))


def all_not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda left, right: left & right, (F.col(c).isNotNull() for c in columns), F.lit(True))
