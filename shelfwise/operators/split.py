"""Hold-out split and the guards before a fit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.impute import id_hash
from shelfwise.operators.quantiles import kth_values


def split_key(id_column: str) -> Column:
    """A number drawn from the id; rows are dealt to the test side in its order."""
    return id_hash(F.col(id_column).cast("string"), 13).cast("double")


def class_counts(
    df: DataFrame, label: str, max_classes: int | None = None
) -> dict[int, int]:
    """Rows per class; more than ``max_classes`` are an error if the caller sets it."""
    found = df.groupBy(label).agg(F.count("*").alias("n"))
    rows = found.collect() if max_classes is None else found.take(max_classes + 1)
    if max_classes is not None and len(rows) > max_classes:
        raise ValueError(f"{label!r} has more than {max_classes} classes")
    return {r[label]: r["n"] for r in rows}


def class_profile(df: DataFrame, label: str) -> DataFrame:
    """Number of classes and size of the smallest one."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("class_count"), F.min("n").alias("min_class_count")
    )


def can_stratify(counts: dict[int, int], test_share: float = 0.2) -> bool:
    """Every class needs two rows and the test side room for every class."""
    rows = sum(counts.values())
    test_rows = max(1, round(rows * test_share))
    return min(counts.values()) >= 2 and test_rows >= len(counts)


def test_sizes(counts: dict[int, int], test_share: float = 0.2) -> dict[int, int]:
    """Test rows per class: proportional, the remainder to the largest fractions."""
    rows = sum(counts.values())
    wanted = math.ceil(rows * test_share)
    exact = {c: wanted * n / rows for c, n in counts.items()}
    sizes = {c: math.floor(x) for c, x in exact.items()}
    by_fraction = sorted(counts, key=lambda c: (sizes[c] - exact[c], c))
    for c in by_fraction[: wanted - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def with_test_flag(
    df: DataFrame, label: str, id_column: str = "product_id", test_share: float = 0.2
) -> DataFrame:
    """Add ``is_test``: an exact share per class where that is possible.

    The last test row of every class is found by rank, so the split itself is a map
    with no shuffle, and a class that holds most rows does not end up in one task.
    """
    counts = class_counts(df, label)
    key = split_key(id_column)
    if can_stratify(counts, test_share):
        sizes = test_sizes(counts, test_share)
        groups = {c: F.col(label) == c for c in counts}
    else:
        sizes = {0: math.ceil(sum(counts.values()) * test_share)}
        groups = {0: F.lit(True)}
    wanted = {
        f"class_{i}": (F.when(groups[c], key), sizes[c] - 1)
        for i, c in enumerate(sizes)
        if sizes[c]
    }
    cuts = kth_values(df, wanted)
    is_test = F.lit(False)
    for i, c in enumerate(sizes):
        if sizes[c]:
            is_test = is_test | (groups[c] & (key <= cuts[f"class_{i}"]))
    return df.withColumn("is_test", is_test)


def check_trainable(df: DataFrame, label: str, features: list[str]) -> dict[int, int]:
    """Guards before a classifier fit; gives the class counts back."""
    if label not in df.columns:
        raise ValueError(f"target column {label!r} not found")
    if not features:
        raise ValueError("no numeric features to train on")
    counts = class_counts(df, label)
    if not counts:
        raise ValueError("the training table is empty")
    if len(counts) < 2:
        raise ValueError(f"training needs two classes in {label!r}, found {len(counts)}")
    return counts


def check_clusterable(df: DataFrame, columns: tuple[str, ...], at_least: int = 4) -> int:
    """Guards before a clustering fit; gives the row count back."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing clustering columns: {missing}")
    rows = df.count()
    if rows < at_least:
        raise ValueError(f"clustering needs at least {at_least} rows, found {rows}")
    return rows
