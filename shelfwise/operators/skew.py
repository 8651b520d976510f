"""Joins whose left side may hold very many rows of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import checked_broadcast

# A key with more rows than this is kept out of the shuffle.
HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list:
    """Keys with more than ``hot_rows`` rows, at most a thousand.

    Counted by a frequency sketch of fixed size per task, so nothing but the sketches is
    shuffled. Its error is far below a thousandth of the rows; a key missed here is
    still joined rightly, only by shuffle.
    """
    found = df.agg(F.expr(f"approx_top_k(`{key}`, 1000, 10000)").alias("top")).first()["top"]
    return [r["item"] for r in found if r["item"] is not None and r["count"] > hot_rows]


def join_split_hot(
    left: DataFrame, right: DataFrame, key: str, how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join on ``key`` (inner, left, left_semi or left_anti), large keys apart.

    Rows of large keys stay where they are and meet the matching rows of ``right`` by
    broadcast, all others by an ordinary join. ``right`` has at most a few rows per key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    hot = hot_keys(left, key, hot_rows)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    large = left.where(is_hot).join(checked_broadcast(right.where(is_hot)), key, how)
    others = left.where(~is_hot).join(right.where(~is_hot), key, how)
    return large.unionByName(others)
