"""Deterministic stand-ins for ratings and review counts a payload lacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_hash(text: Column, hex_digits: int = 8) -> Column:
    """Leading hex digits of the MD5 of a text as a number (at most 13 digits)."""
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def imputed_rating(product_id: Column) -> Column:
    """3.0 to 5.0 in steps of one tenth, fixed by the id."""
    return (F.lit(30) + id_hash(product_id) % 21) / F.lit(10.0)


def imputed_review_count(product_id: Column) -> Column:
    """0 to 850, fixed by the id."""
    return id_hash(product_id) % 851
