"""Errors of two severities: of rows, which a batch may survive, and of its safety, which it never does.

Which error ends a job doesn't depend on partitions: it is the first one in the order of the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = ("error_type", "message")


def first_error(errors: DataFrame, *order: str) -> DataFrame:
    """One row: error_type and message of the first error by `order`, null without any. Partial minima, no sort."""
    first = F.min_by(F.struct(*ERROR), F.struct(*order))
    return errors.agg(first.alias("_e")).select(*[F.col(f"_e.{c}").alias(c) for c in ERROR])


def require_none(rows: DataFrame, errors: DataFrame, *order: str) -> DataFrame:
    """`rows`, unless there are errors: then the job ends and names the first one by `order`."""
    first = first_error(errors, *order).select(F.concat_ws(": ", *ERROR).alias("_what"), F.col("error_type").isNotNull().alias("_bad"))
    joined = rows.crossJoin(F.broadcast(first))  # one row
    good = F.when(F.col("_bad"), F.raise_error(F.col("_what")).cast("boolean")).otherwise(F.lit(True))
    return joined.filter(good).drop("_what", "_bad")


def split_batch(rows: DataFrame, order: list[str], unsafe: DataFrame | None = None, continue_on_error: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) of `rows` with error_type and message (null: good). `unsafe` (error_type, message and the columns of
    `order`) are safety errors: the first one ends the job even with continue_on_error; without it the first error of either kind
    does. Nothing is written by a job that ends."""
    bad = rows.filter(F.col("error_type").isNotNull())
    ends = unsafe
    if not continue_on_error:
        own = bad.select(*order, *ERROR)
        ends = own if unsafe is None else own.unionByName(unsafe.select(*order, *ERROR))
    good = rows.filter(F.col("error_type").isNull()).drop(*ERROR)
    if ends is None:
        return good, bad
    return require_none(good, ends, *order), require_none(bad, ends, *order)


def chain(*checks: tuple[Column, str, Column | str]) -> dict[str, Column]:
    """error_type and message of the first check (condition, type, message) that holds; null if none does. A condition that is null doesn't
    hold."""
    kind, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, name, text in reversed(checks):
        holds = F.coalesce(condition, F.lit(False))
        kind, message = F.when(holds, F.lit(name)).otherwise(kind), F.when(holds, text if isinstance(text, Column) else F.lit(text)).otherwise(message)
    return {"error_type": kind, "message": message}
