"""Casting a frame to a declared schema, as an assignment to its columns would."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import whole_days


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order. A column that the frame lacks is NULL; a
    fraction assigned to an INT is rounded half to even; a value that does not fit the
    narrower type is an error (ANSI mode)."""
    present = {f.name: f.dataType for f in frame.schema.fields}
    return frame.select(*[_assigned(f, present.get(f.name)).alias(f.name) for f in schema.fields])


def _assigned(field: T.StructField, source: T.DataType | None) -> Column:
    if source is None:
        return F.lit(None).cast(field.dataType)
    column = F.col(field.name)
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(
        field.dataType, T.IntegerType
    ):
        return whole_days(column)
    return column.cast(field.dataType)
