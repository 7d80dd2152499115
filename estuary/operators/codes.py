"""Code dictionaries (B1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOTTOM_FIELD, VEG_FIELD, SHORE_FIELD = "BottomType", "BottomVeg", "ShoreType"


def codes_for(codes: DataFrame, fieldname: str) -> DataFrame:
    """B1: (code, description, category) of one field.

    Joined without a hint: the planner broadcasts a list whose files are
    under the threshold in bytes, adaptive execution one that turns out to
    be, and a longer list is joined by shuffle, where skewed codes are split.
    No job runs while a plan is built.
    """
    return codes.where(F.col("fieldname") == fieldname).select("code", "description", "category")


def ranked_codes(codes: DataFrame, fieldname: str) -> DataFrame:
    """B1 with ``rank``: 1, 3, 5, ... in the order of code and description.

    The even numbers are left for codes that the list lacks, see ``code_rank``.
    """
    listed = codes_for(codes, fieldname).where(F.col("code").isNotNull())
    return listed.withColumn("rank", 2 * F.row_number().over(Window.orderBy("code", "description")) - 1)


def code_rank(code: str, rank: str, ranked: DataFrame) -> Column:
    """Place of a code among the listed ones, after a left join with them.

    A listed code has its rank; any other takes the even number between its
    neighbours.  Codes of one gap are not told apart, and need not be: none of
    them has a description.  The sorted list is a subquery of the plan, asked
    for unlisted codes only.
    """
    listed = ranked.agg(F.collect_list("code").alias("codes")).scalar()
    below = F.array_position(F.sort_array(F.array_append(listed, F.col(code))), F.col(code)) - 1
    return F.when(F.col(rank).isNotNull(), F.col(rank)).otherwise(2 * below)
