"""Column name and missing value helpers."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Replace ``-`` and blanks in column names by ``_``."""
    return df.toDF(*[re.sub("[- ]", "_", c) for c in df.columns])


def table_name(path: str) -> str:
    """Table name of a file: its base name without extension."""
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes null; other columns pass through."""
    floats = {name for name, kind in df.dtypes if kind in ("float", "double")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def shipping_seconds(delivered: str, purchased: str) -> Column:
    """Whole seconds from purchase to delivery, cut toward zero; 0 where either is missing."""
    seconds = F.timestamp_diff("SECOND", F.col(purchased), F.col(delivered))
    return F.coalesce(seconds, F.lit(0)).cast("bigint")


def year_month(c: str) -> Column:
    return F.date_format(c, "yyyy-MM")


def thousands(c: Column) -> Column:
    """Two decimals with thousands separators, as text."""
    return F.format_number(c, 2)
