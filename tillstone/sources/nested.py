"""Nested columns as JSON text, and landing lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_nested(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text; other columns untouched."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select([
        F.to_json(field.name).alias(field.name) if isinstance(field.dataType, nested) else F.col(field.name)
        for field in df.schema.fields
    ])


def with_landing_lineage(df: DataFrame, sheet_name: str, processed_at: str) -> DataFrame:
    return df.withColumns({"_source_sheet": F.lit(sheet_name), "_processed_at": F.lit(processed_at)})
