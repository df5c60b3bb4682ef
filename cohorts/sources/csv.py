"""CSV scan and sink for the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import blank_to_null, col, text_to_double, text_to_long
from cohorts.schema import customer_schema


# How quotes are written inside quoted cells, on both sides.
QUOTES = {"quote": '"', "escape": '"'}


def read_csv_text(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Every column as text, bound by header name; missing-value tokens become NULL.

    A quote inside quotes is doubled. Cells with line breaks need ``multiLine="true"``, which makes a file one task's work.
    """
    raw = spark.read.options(**{"header": True, "enforceSchema": False, **QUOTES, **options}).csv(path)
    return raw.select(*[blank_to_null(col(c)).alias(c) for c in raw.columns])


def cast_columns(text: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Cast text columns named in ``schema``; others stay text. Bad cells give NULL."""
    kinds = {f.name: f.dataType for f in (schema or customer_schema()).fields}

    def cast(name: str):
        kind = kinds.get(name, T.StringType())
        if isinstance(kind, (T.LongType, T.IntegerType)):
            return text_to_long(col(name)).cast(kind).alias(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.nanvl(text_to_double(col(name)), F.lit(None).cast("double")).cast(kind).alias(name)
        return col(name).alias(name)

    return text.select(*[cast(c) for c in text.columns])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options: str) -> DataFrame:
    return cast_columns(read_csv_text(spark, path, **options), schema)


def write_csv(df: DataFrame, path: str, single_file: bool = False, **options: str) -> str:
    """Folder of CSV part files with a header, replacing what was there.

    ``single_file`` sends all rows through one task; meant for small exports.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**{"header": True, **QUOTES, **options}).csv(path)
    return path
