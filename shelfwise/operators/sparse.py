"""One-hot vectors for any number of categories: an indexed vocabulary table, sparse vectors.

``features.one_hot`` makes a column per value, which is what a small taxonomy needs. Free-text
categories have far more values than a table has columns; here their vocabulary stays a
table, is joined by value and becomes a sparse vector of one entry per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.skew import join_split_hot
from shelfwise.session import written

#: Rows that a range of the vocabulary has about.
RANGE_ROWS = 1_000_000


def _spelling(column: Column) -> Column:
    """Values that differ only in case are one, as column names would have it."""
    return F.lower(column.cast("string"))


def fit_vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A written table (``name``, ``value``, ``index``): the values of each column in order, from 0.

    Nothing is collected but the sizes of ranges: values are sorted into ranges and numbered
    inside a range after those of the ranges before. Null is no value. The same values have
    the same numbers in every run.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("name"), _spelling(F.col(f"`{c}`")).alias("value")) for c in columns])
    found = written(
        df.select(F.explode(cells).alias("c")).select("c.*").where("value is not null").distinct(),
        "values",
    )
    ranges = max(1, -(-found.count() // RANGE_ROWS))
    ranged = found.repartitionByRange(ranges, "name", "value").withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sizes = ranged.groupBy("name", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("name", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("name", "_range").orderBy("value")
    numbered = ranged.join(starts, ["name", "_range"]).withColumn(
        "index", (F.col("_start") + F.row_number().over(inside) - 1).cast("long")
    )
    return written(numbered.select("name", "value", "index"), "vocabulary")


def indexed(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_index`` for each column; null for null and for unknown values.

    A value with very many rows is joined by broadcast of its one vocabulary row.
    """
    for c in columns:
        keyed = df.withColumn("_value", _spelling(F.col(f"`{c}`")))
        known = vocabulary.where(F.col("name") == c).select(
            F.col("value").alias("_value"), F.col("index").alias(f"{c}_index")
        )
        df = join_split_hot(keyed, known, "_value", "left").drop("_value")
    return df


def vocabulary_sizes(vocabulary: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    sizes = {r.name: r.n for r in vocabulary.groupBy("name").agg(F.count("*").alias("n")).collect()}
    return {c: sizes.get(c, 0) for c in columns}


def one_hot_vectors(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_vector`` instead of each column: sparse, of the vocabulary's size.

    The entry of a row's value is 1; null and values that the vocabulary lacks have no entry. A column
    without any value has a vector of size 1 without entries.
    """
    sizes = vocabulary_sizes(vocabulary, columns)
    rows = indexed(df, vocabulary, columns)
    # One number past the last stands for null and unknown values; dropLast leaves its entry out.
    numbers = {f"{c}_index": F.coalesce(f"{c}_index", F.lit(max(sizes[c], 1))).cast("double") for c in columns}
    rows = rows.withColumns(numbers)
    spark = df.sparkSession
    for c in columns:
        encoder = OneHotEncoder(inputCols=[f"{c}_index"], outputCols=[f"{c}_vector"], dropLast=True)
        # The encoder learns the number of categories from the greatest index alone.
        most = spark.createDataFrame([(float(max(sizes[c], 1)),)], f"`{c}_index` double")
        rows = encoder.fit(most).transform(rows)
    return rows.drop(*[f"{c}_index" for c in columns], *columns)


def feature_vectors(df: DataFrame, numeric: Sequence[str], vectors: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns (null as 0) and vectors as one vector, for the fits of ``pyspark.ml``."""
    plain = {f"_n{i}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for i, c in enumerate(numeric)}
    assembler = VectorAssembler(inputCols=[*plain, *vectors], outputCol=out)
    return assembler.transform(df.withColumns(plain)).drop(*plain)
