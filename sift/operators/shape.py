"""Declared types and columns of the accepted rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sift.functions import names
from sift.functions.coerce import lenient_cast
from sift.operators.tally import Tally
from sift.sources.rulefile import expand_all


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; a value that does not fit its type becomes NULL."""
    exact_case = names.case_sensitive(df.sparkSession)
    projection = {at: names.column(field.name) for at, field in enumerate(df.schema)}
    for name, type_name in types.items():
        at = names.find(name, df.columns, exact_case)
        if at is None:
            raise ValueError(f"unknown column {name!r}")
        cast = lenient_cast(projection[at], df.schema[at].dataType, type_name)
        projection[at] = cast.alias(names.bare(name))
    return df.select(*projection.values())


def loss_columns(
    t: Tally, df: DataFrame, types: Mapping[str, str]
) -> dict[tuple[str, str], Column]:
    """For each declared cast (column, type) the accepted rows of a tally over
    `df` whose value it turns into NULL."""
    exact_case = names.case_sensitive(df.sparkSession)
    found = {}
    for name, type_name in types.items():
        field = df.schema[names.find(name, df.columns, exact_case)]
        value = t.position(field.name)
        lost = value.isNotNull() & lenient_cast(value, field.dataType, type_name).isNull()
        found[names.bare(name), type_name] = F.count_if(t.passes & lost)
    return found


def cast_losses(t: Tally, df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """(column_name, type, losses), one row per declared cast."""
    columns = loss_columns(t, df, types)
    if not columns:
        empty = "column_name string, type string, losses bigint"
        return df.sparkSession.createDataFrame([], empty)
    counted = t.frame.agg(*(column.alias(f"n{at}") for at, column in enumerate(columns.values())))
    rows = (
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(type_name).alias("type"),
            F.col(f"n{at}").alias("losses"),
        )
        for at, (name, type_name) in enumerate(columns)
    )
    return counted.select(F.inline(F.array(*rows)))


def project_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the declared columns, in the declared order and spelling; `*` is all."""
    exact_case = names.case_sensitive(df.sparkSession)
    wanted = expand_all(wanted, df.columns)
    found = [names.find(name, df.columns, exact_case) for name in wanted]
    missing = [name for name, at in zip(wanted, found) if at is None]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    return df.select(
        *(names.column(df.columns[at]).alias(names.bare(name)) for name, at in zip(wanted, found))
    )
