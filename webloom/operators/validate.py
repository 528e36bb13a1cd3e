"""Validation of JSON lines: which rows are page records, and why the others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import strip
from webloom.schemas import PAGE, REQUIRED_KEYS


def skip_reason(line: Column, required: list[str] = REQUIRED_KEYS) -> Column:
    """``blank``, ``invalid_json``, ``missing_keys`` or null for a valid record; keys with null values count as there."""
    keys = F.json_object_keys(line)
    wanted = F.array(*[F.lit(k) for k in required])
    return F.when(F.coalesce(strip(line), F.lit("")) == "", "blank").when(keys.isNull(), "invalid_json").when(F.size(F.array_except(wanted, keys)) > 0, "missing_keys")


def validated(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.withColumn("skip_reason", skip_reason(F.col(col)))


def summary(checked: DataFrame) -> DataFrame:
    """total, valid and skipped."""
    ok = F.col("skip_reason").isNull()
    return checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("skipped"))


def valid_pages(lines: DataFrame, col: str = "value", need_one: bool = False) -> DataFrame:
    """PAGE rows of the valid lines; with ``need_one`` an input without any is an error."""
    good = validated(lines, col).filter(F.col("skip_reason").isNull())
    if need_one and good.isEmpty():
        raise ValueError("no valid record")
    return good.select(F.from_json(F.col(col), PAGE).alias("p")).select("p.*")
