"""Places of rows in an order within large groups: no group is ever in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastrum.sources.shared import written


def ranked(df: DataFrame, by: list[str], order: list[Column | str], name: str = "place") -> DataFrame:
    """df with each row's place (from 1) in its group by an order that leaves no ties (`by` and the order's columns aside, the rows may hold anything). Rows are dealt to tasks by ranges of group and order and written sorted, so a group may span any number of files; a row's place is its number in its file less the group's first there, and what earlier files hold of the group, which is a row for each group and file."""
    sort = [*by, *order]
    rows = written(df.repartitionByRange(*sort).sortWithinPartitions(*sort)).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    held = rows.groupBy(*by, "_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = held.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    on = reduce(and_, (F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in [*by, "_file"]))
    met = rows.alias("r").join(before.alias("h"), on)
    return met.select(*(F.col(f"r.{c}") for c in df.columns), (F.col("r._at") - F.col("h._first") + F.col("h._before") + 1).cast("long").alias(name))


def with_next(df: DataFrame, by: list[str], order: list[Column | str], column: str, name: str = "next") -> DataFrame:
    """df with a column's value in the next row of its group by an order without ties, null in the last: by a join on places."""
    placed = written(ranked(df, by, order, "_place"))
    after = placed.select(*(F.col(c).alias(f"_{c}") for c in by), (F.col("_place") - 1).alias("_before"), F.col(column).alias(name))
    on = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by)) & (F.col("_place") == F.col("_before"))
    return placed.join(after, on, "left").select(*df.columns, name)
