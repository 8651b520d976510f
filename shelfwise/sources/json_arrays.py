"""Files that hold one JSON array each, read by many tasks however long the array is.

A file is read in byte ranges, cut after every closing brace. Whether a range begins inside
a string, and how deep in the array, depends on all ranges before it. Each range is first
summed up for both cases, inside and outside a string: how it ends, and by how much the
depth changes. These sums, a row per range, are put together in the order of the file and
give the state at the start of every range; then all ranges are cut into elements at once.
What lies at the ends of a range is a piece of an element, joined to those beside it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import pinned, written

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|"|[\[\]{},]', re.S)
#: Ranges whose states go to all tasks at most; the states of more are joined by shuffle.
SENT_RANGES = 100_000


def _passed(text: str, inside: bool) -> tuple[bool, int]:
    """(whether the end lies in a string, change of depth) of a text that begins so."""
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return True, 0
        text = text[end.end() :]
    plain = _STRING.sub("", text)
    at = plain.find('"')
    if at >= 0:
        plain = plain[:at]
    opened = plain.count("{") + plain.count("[")
    return at >= 0, opened - plain.count("}") - plain.count("]")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per range: its end and change of depth when it begins outside and inside a string."""
    key, ends, depths, first = None, [False, True], [0, 0], ""

    def row() -> pa.RecordBatch:
        values = [*key, *ends, *depths, first]
        names = ["path", "start", "end_out", "end_in", "depth_out", "depth_in", "first"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("path", "start", "value"))
        for path, start, value in zip(*columns, strict=True):
            if (path, start) != key:
                if key is not None:
                    yield row()
                key, ends, depths, first = (path, start), [False, True], [0, 0], ""
            first = first or value.lstrip("﻿ \t\r\n")[:1]
            text = value + "}"
            after = [_passed(text, e) for e in sorted(set(ends))]
            known = dict(zip(sorted(set(ends)), after, strict=True))
            depths = [d + known[e][1] for d, e in zip(depths, ends, strict=True)]
            ends = [known[e][0] for e in ends]
    if key is not None:
        yield row()


def _states(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of every range of one file."""
    ranges = ranges.sort_values("start")
    inside, depth, rows = False, 0, []
    for r in ranges.itertuples():
        rows.append((r.path, r.start, inside, depth))
        depth += r.depth_in if inside else r.depth_out
        inside = r.end_in if inside else r.end_out
    return pd.DataFrame(rows, columns=["path", "start", "inside", "depth"])


class _Cutter:
    """Cuts a range, given text by text, into the elements of the array."""

    def __init__(self, inside: bool, depth: int) -> None:
        self.inside, self.depth = inside, depth
        #: Texts since the last boundary; the first piece belongs to an element begun before.
        self.open: list[str] = []
        self.pieces: list[tuple[bool, str]] = []

    def _boundary(self) -> None:
        self.pieces.append((True, "".join(self.open)))
        self.open = []

    def add(self, text: str) -> None:
        begin = at = 0
        if self.inside:
            end = _STRING_END.match(text)
            if end is None:
                self.open.append(text)
                return
            at, self.inside = end.end(), False
        for mark in _MARK.finditer(text, at):
            sign = mark.group()
            if sign == '"':
                self.inside = True
                break
            if sign in "[{":
                self.depth += 1
                if self.depth == 1:
                    # What stands before the array is no part of it.
                    self.open, begin = [], mark.end()
                    self._boundary()
            elif sign in "]}":
                self.depth -= 1
                if self.depth == 0:
                    self.open.append(text[begin : mark.start()])
                    self._boundary()
                    begin = mark.end()
            elif sign == "," and self.depth == 1:
                self.open.append(text[begin : mark.start()])
                self._boundary()
                begin = mark.end()
        self.open.append(text[begin:])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole elements, and the pieces at both ends of every range.

    ``begins`` says that a piece starts an element, ``ends`` that it is the last of one; only
    a range without any boundary is neither.
    """
    key, cutter, nth, rows = None, None, 0, []

    def take(last: bool) -> None:
        nonlocal nth
        for _, text in cutter.pieces:
            rows.append((*key, nth, nth > 0, True, text))
            nth += 1
        cutter.pieces = []
        if last:
            # After the array's end depth is 0, and what follows is no element.
            text = "".join(cutter.open) if cutter.depth > 0 else ""
            rows.append((*key, nth, nth > 0, False, text))

    def out() -> pa.RecordBatch:
        names = ["path", "start", "nth", "begins", "ends", "text"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("path", "start", "inside", "depth", "value"))
        for path, start, inside, depth, value in zip(*columns, strict=True):
            if (path, start) != key:
                if key is not None:
                    take(True)
                key, cutter, nth = (path, start), _Cutter(inside, depth), 0
            cutter.add(value + "}")
        if key is not None:
            take(False)
        yield out()
    if key is not None:
        take(True)
    yield out()


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements as the text of an object or array, or the plain text of a value."""
    for batch in batches:
        values = []
        for text in batch.column("text").to_pylist():
            text = text.strip()
            if text:
                values.append(json.loads(text) if text[0] == '"' else None if text == "null" else text)
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["raw"])


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """(``raw``): the elements of the JSON arrays in the files below ``path``, one row each.

    Objects and arrays as their text, strings without quotes, null as null. A file whose
    first sign is no bracket, or that holds blanks only, raises ValueError; a file of no
    bytes has no elements. What follows the array is not read. An element may be longer
    than a range; a task holds one element at a time.
    """
    texts = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    schema = (
        "path string, start long, end_out boolean, end_in boolean, depth_out long, "
        "depth_in long, first string"
    )
    sums = written(texts.mapInArrow(_sums, schema), "json-ranges")
    first = F.min(F.when(F.col("first") != "", F.struct("start", "first")))
    firsts = sums.groupBy("path").agg(first.alias("f")).select("f.first")
    if not firsts.where("first is null or first <> '['").isEmpty():
        raise ValueError(f"expected a JSON array in every file of {path}")
    states = written(
        sums.groupBy("path").applyInPandas(_states, "path string, start long, inside boolean, depth long"),
        "json-states",
    )
    small = pinned(states, SENT_RANGES)
    if small is not None:
        stated = texts.join(F.broadcast(small), ["path", "start"])
    else:
        numbered = texts.withColumn("_n", F.monotonically_increasing_id())
        stated = numbered.join(states, ["path", "start"]).repartition("path", "start")
        stated = stated.sortWithinPartitions("path", "start", "_n")
    pieces = written(
        stated.select("path", "start", "inside", "depth", "value").mapInArrow(
            _pieces, "path string, start long, nth long, begins boolean, ends boolean, text string"
        ),
        "json-pieces",
    )
    whole = pieces.where("begins and ends").select("text")
    # The others, two a range, are joined in the order of the file.
    loose = pieces.where("not (begins and ends)")
    order = Window.partitionBy("path").orderBy("start", "nth")
    element = F.sum(F.col("begins").cast("long")).over(order)
    joined = (
        loose.withColumn("_element", element)
        .groupBy("path", "_element")
        .agg(F.array_sort(F.collect_list(F.struct("start", "nth", "text"))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    )
    return whole.union(joined).mapInArrow(_plain, "raw string")
