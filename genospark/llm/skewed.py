"""Joining rows to a row of their group when some groups are very large."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group with more than this part of all rows is joined by broadcast; there are
#: fewer than HOT_PARTS such groups, whatever the number of rows.
HOT_PARTS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` inner join ``groups`` on ``key`` (unique in ``groups``); the column ``size`` of
    ``groups`` is the group's number of rows and ``total`` the sum of it."""
    hot = F.col(size) > F.lit(max(total // HOT_PARTS, 1))
    marked = rows.join(F.broadcast(groups.where(hot).withColumn("__hot", F.lit(True))), key, "left")
    columns = [*rows.columns, *(c for c in groups.columns if c != key)]
    few = marked.where("__hot IS NULL").select(*rows.columns).join(groups.where(~hot), key)
    return marked.where("__hot").select(*columns).unionByName(few.select(*columns))
