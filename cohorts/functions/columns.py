"""Small column expressions shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that a CSV reader takes for a missing number.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# What counts as a number, a whole number and a truth value in text.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
TRUTH_PATTERN = r"^(True|TRUE|true|False|FALSE|false)$"


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def ident(name: str) -> str:
    """Name quoted for SQL text. Wide expressions are written as SQL text: one call instead of hundreds."""
    return "`" + name.replace("`", "``") + "`"


def number(value: float) -> str:
    """A double literal that reads back as exactly the same value."""
    value = float(value)
    if math.isfinite(value):
        return f"({value!r}D)"
    return f"double('{value!r}')"


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def as_double(df: DataFrame, name: str) -> Column:
    """The column as double with NaN turned into NULL."""
    return F.expr(double_sql(df, name))


def double_sql(df: DataFrame, name: str) -> str:
    """SQL text of the column as double: NaN and missing tokens give NULL, a word in a text column raises."""
    if isinstance(df.schema[name].dataType, T.StringType):
        cell = ident(name)
        tokens = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
        pattern = NUMBER_PATTERN.replace("\\", "\\\\")
        label = name.replace("'", "")
        return (
            f"case when {cell} is null or {cell} in ({tokens}) then null "
            f"when {cell} rlike '{pattern}' then try_cast(trim({cell}) as double) "
            f"else cast(raise_error(concat('not a number in {label}: ', {cell})) as double) end"
        )
    text = f"cast({ident(name)} as double)"
    return f"nanvl({text}, cast(null as double))" if is_float(df, name) else text


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def blank_to_null(value: Column) -> Column:
    return F.when(~value.isin(MISSING_TOKENS), value)


def text_to_double(value: Column) -> Column:
    """Number in text as double; anything that is not a plain number gives NULL."""
    return F.when(value.rlike(NUMBER_PATTERN), F.trim(value).try_cast("double"))


def text_to_long(value: Column) -> Column:
    """Whole number in text, also when written as ``12.0``; exact for long integers."""
    as_number = text_to_double(value)
    return F.coalesce(
        F.when(value.rlike(INTEGER_PATTERN), F.trim(value).try_cast("bigint")),
        F.when(as_number == F.floor(as_number), as_number.try_cast("bigint")),
    )


def rounded(value: Column, places: int = 6) -> Column:
    """Rounded, with negative zero made zero."""
    return F.round(value, places) + F.lit(0.0)


def squared_distance(left: list[str], right: list[str]) -> str:
    """SQL text of the squared distance between two lists of SQL terms, summed in list order."""
    return " + ".join(f"({a} - {b}) * ({a} - {b})" for a, b in zip(left, right))


def squares(terms: list[str]) -> str:
    """SQL text of the sum of squares of SQL terms."""
    return " + ".join(f"({t}) * ({t})" for t in terms)
