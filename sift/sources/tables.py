"""Readers and writers for the source, the two row outputs and the audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.functions import names
from sift.functions.coerce import TEXT_TYPES

# A faithful CSV spells NULL with a mark that no text can have, and keeps line
# breaks out of the lines, so that the files can still be read in splits. The
# escape character's own spelling comes first.
NULL_MARK = "~N"
_SPELLED = (("~", "~0"), ("\n", "~1"), ("\r", "~2"))

_FAITHFUL = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": NULL_MARK,
    "escape": '"',
}


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        *(
            change(names.column(f.name)).alias(f.name)
            if isinstance(f.dataType, TEXT_TYPES)
            else names.column(f.name)
            for f in df.schema
        )
    )


def _spell(text: Column) -> Column:
    for plain, spelled in _SPELLED:
        text = F.replace(text, F.lit(plain), F.lit(spelled))
    return text


def _unspell(text: Column) -> Column:
    for plain, spelled in reversed(_SPELLED):
        text = F.replace(text, F.lit(spelled), F.lit(plain))
    return text


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    schema: T.StructType | None = None,
    faithful: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """CSV as text columns, named by the header or `_c0`, `_c1`, ...

    No type inference, so the files are read once and every value keeps its
    spelling. A given schema saves the look at the first line. Short lines are
    padded with NULL and surplus fields dropped; `malformed` names one more
    column that holds the whole line where that was done, else NULL.
    """
    reader = spark.read.option("header", header)
    if faithful:
        reader = reader.options(**_FAITHFUL)
    if malformed is not None:
        schema = schema or reader.csv(path).schema
        schema = T.StructType([*schema, T.StructField(malformed, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.csv(path)
    return _texts(rows, _unspell) if faithful else rows


def write_csv(df: DataFrame, path: str, *, header: bool = True, faithful: bool = False) -> None:
    """Overwrite with CSV. The default trims blanks around values, writes NULL
    as nothing, and breaks lines where values do; `faithful` brings back every
    text as it was, line breaks, quotes, blanks, '' and NULL included."""
    if faithful:
        df = _texts(df, _spell)
    writer = df.write.mode("overwrite").option("header", header)
    if faithful:
        writer = writer.options(**_FAITHFUL)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
