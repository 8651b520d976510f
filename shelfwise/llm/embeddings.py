"""Near-duplicate vectors by collision counting over one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import numbered, written
from shelfwise.llm.components import components

COSINE = 0.98
#: Projections whose cells make up the sort key of one list.
GATES = 8
#: Width of a cell in standard deviations of the projected difference of a just-linked pair.
CELL = 4.0
#: Projections whose window collisions are counted, and half a window in such deviations.
COUNTED = 128
WINDOW = 1.0
#: Share of just-linked pairs that may miss all lists, or fail the count.
MISSED = 1e-4
#: Longer lists are dealt over pairs of tiles of about this many vectors.
TILE = 1024
#: Vectors of a list that meet the others of it at a time.
BLOCK = 16
SEED = 11


def _distance(cosine: float) -> float:
    return float(np.sqrt(2 - 2 * cosine))


@lru_cache(maxsize=8)
def directions(dim: int, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit directions of the cells with their shifts, and of the counted projections."""
    rng = np.random.default_rng([SEED, dim])
    counted = rng.normal(size=(COUNTED, dim))
    counted /= np.linalg.norm(counted, axis=1, keepdims=True)
    gates = rng.normal(size=(lists * GATES, dim))
    gates /= np.linalg.norm(gates, axis=1, keepdims=True)
    return gates, rng.random(lists * GATES), counted


@lru_cache(maxsize=8)
def calibrated(dim: int, cosine: float) -> tuple[int, int]:
    """Number of lists, and the least count of collisions, that reach the recall.

    Measured on pairs at exactly the least cosine, which are the hardest to find.
    """
    rng = np.random.default_rng([SEED, dim, 1])
    x = rng.normal(size=(4000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.normal(size=(4000, dim))
    step -= (step * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(step, axis=1, keepdims=True)
    step = np.where(length > 1e-9, step / np.maximum(length, 1e-9), 0.0)
    y = cosine * x + np.sqrt(1 - cosine**2) * step
    gates, shifts, counted = directions(dim, 64)
    width = CELL * _distance(cosine) / np.sqrt(dim)
    same = np.floor(x @ gates.T / width + shifts) == np.floor(y @ gates.T / width + shifts)
    met = same.reshape(len(x), 64, GATES).all(axis=2).mean(axis=0).mean()
    lists = int(np.ceil(np.log(MISSED) / np.log(max(1 - met, 1e-9))))
    half = WINDOW * _distance(cosine) / np.sqrt(dim)
    count = (np.abs(x @ counted.T - y @ counted.T) <= half).sum(axis=1)
    mean, spread = count.mean(), count.std()
    return max(lists, 8), max(0, int(np.floor(mean - 4.5 * spread)))


def list_keys(x: np.ndarray, cosine: float, lists: int) -> np.ndarray:
    """For every vector the hash of its cells in every list."""
    dim = x.shape[1]
    gates, shifts, _ = directions(dim, lists)
    width = CELL * _distance(cosine) / np.sqrt(dim)
    cells = np.floor(x @ gates.T / width + shifts).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(x), lists, GATES)
    own = np.arange(1, lists + 1, dtype=np.uint64) + np.uint64(dim << 20)
    own *= np.uint64(0xBF58476D1CE4E5B9)
    key = np.broadcast_to(own ^ (own >> np.uint64(31)), cells.shape[:2])
    for g in range(GATES):
        key = (key ^ cells[:, :, g]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def unit_vectors(table: DataFrame) -> DataFrame:
    """``body``: the unit vector as doubles in bytes, null when the row can link with nothing.

    That is without a label, with a null or empty vector, a null or non-finite component,
    or length zero.
    """

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies: list[bytes | None] = []
            dims: list[int] = []
            vectors, labels = batch.column("embedding"), batch.column("label")
            for i in range(len(vectors)):
                body, dim = None, 0
                if vectors[i].is_valid and labels[i].is_valid and len(vectors[i]):
                    values = vectors[i].values
                    if values.null_count == 0:
                        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                        most = np.abs(x).max()
                        if np.isfinite(most) and most > 0:
                            x = x / most
                            body, dim = (x / np.linalg.norm(x) + 0.0).tobytes(), len(x)
                bodies.append(body)
                dims.append(dim)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    batch.column("vec_id"),
                    labels,
                    pa.array(bodies, pa.binary()),
                    pa.array(dims, pa.int32()),
                ],
                ["rid", "vec_id", "label", "body", "dim"],
            )

    return table.mapInArrow(
        prepare, "rid long, vec_id long, label string, body binary, dim int"
    )


def joined(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place in reach of every place, once the places i and j are linked too."""
    while True:
        low, high = np.minimum(roots[i], roots[j]), np.maximum(roots[i], roots[j])
        if (low == high).all():
            return roots
        roots = roots.copy()
        np.minimum.at(roots, high, low)
        while (roots[roots] != roots).any():
            roots = roots[roots]


PAIRS = "a long, b long, n long"


def counted_pairs(live: DataFrame, cosine: float, lists: dict[int, tuple[int, int]]) -> DataFrame:
    """Links of the vectors that share lists, without a row per pair.

    ``live`` has ``key``, ``low``, ``high`` (the pair of tiles), ``tile``, ``nth`` (the list), ``cid``,
    ``times``, ``body``, ``dim``. For every pair in a list the query-centred window collisions
    over all counted projections are tallied; pairs with enough are verified by cosine. A
    pair counts in the first list that it shares. Out come, per vector, how many vectors it
    links with, and links that join what is connected.
    """

    def run(rows: list, found_n: dict, found_links: set) -> None:
        dim = rows[0][4]
        many, least = lists[dim]
        x = np.frombuffer(b"".join(r[5] for r in rows), dtype=np.float64).reshape(-1, dim)
        _, _, counted = directions(dim, many)
        tile = np.array([r[0] for r in rows])
        nth = rows[0][1]
        cid = np.array([r[2] for r in rows])
        times = np.array([r[3] for r in rows], dtype=np.int64)
        before = list_keys(x, cosine, many)[:, :nth].T
        spots = x @ counted.T
        half = WINDOW * _distance(cosine) / np.sqrt(dim)
        across = tile.min() != tile.max()
        linked = np.zeros(len(rows), dtype=np.int64)
        roots = np.arange(len(rows))
        for start in range(0, len(rows), BLOCK):
            block = np.arange(start, min(start + BLOCK, len(rows)))
            met = np.arange(start, len(rows)) > block[:, None]
            if across:
                met &= tile[start:] != tile[block][:, None]
            i, j = np.nonzero(met)
            i, j = i + start, j + start
            # Copies share most lists: what an earlier list has counted leaves first.
            for key in before:
                new = key[i] != key[j]
                i, j = i[new], j[new]
            near = (np.abs(spots[i] - spots[j]) <= half).sum(axis=1) >= least
            i, j = i[near], j[near]
            found = np.einsum("pd,pd->p", x[i], x[j])
            for p in np.flatnonzero(np.abs(found - cosine) < 1e-9).tolist():
                found[p] = np.dot(x[i[p]], x[j[p]])
            i, j = i[found >= cosine], j[found >= cosine]
            np.add.at(linked, i, times[j])
            np.add.at(linked, j, times[i])
            roots = joined(roots, i, j)
        for k in np.flatnonzero(linked).tolist():
            found_n[cid[k]] = found_n.get(cid[k], 0) + int(linked[k])
        found_links.update(zip(cid.tolist(), cid[roots].tolist(), strict=True))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = [], None
        found_n: dict[int, int] = {}
        found_links: set[tuple[int, int]] = set()

        def out() -> pa.RecordBatch:
            counts = [(c, None, n) for c, n in found_n.items()]
            rows = counts + [(a, b, None) for a, b in found_links if a != b]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            arrays = [pa.array(c, pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b", "n"])

        for batch in batches:
            names = ("key", "low", "high", "tile", "nth", "cid", "times", "dim", "body")
            columns = [batch.column(c).to_pylist() for c in names]
            for key, low, high, *row in zip(*columns, strict=True):
                if (key, row[1], low, high) != at:
                    if len(group) > 1:
                        run(group, found_n, found_links)
                    group, at = [], (key, row[1], low, high)
                group.append(row)
            if len(found_n) + len(found_links) > 200_000:
                yield out()
                found_n, found_links = {}, set()
        if len(group) > 1:
            run(group, found_n, found_links)
        yield out()

    return (
        live.repartition("key", "nth", "low", "high")
        .sortWithinPartitions("key", "nth", "low", "high")
        .mapInArrow(tally, PAIRS)
    )


def near_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``table`` (``vec_id``, ``embedding``, ``label``) with its links.

    ``vec_id``, ``n_links`` (other vectors of the label with a cosine of ``cosine`` or more, in
    double precision), ``component_id`` (smallest ``vec_id`` reachable, itself included) and
    ``kept``. Equal unit vectors of a label are one class that is searched once; its copies
    link with each other. A row without a label or a usable vector links with nothing.
    Vectors of different dimension never link. A null ``vec_id`` is never the smallest, and
    is not kept.
    """
    rows = numbered(
        table,
        "vectors",
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding"),
    )
    rows = written(
        unit_vectors(rows).withColumn("same", F.sha2(F.col("body"), 256)), "unit-vectors"
    )
    usable = rows.where(F.col("body").isNotNull())
    classes = written(
        usable.groupBy("label", "same").agg(
            F.min("rid").alias("cid"),
            F.count("*").alias("times"),
            F.min("vec_id").alias("low_id"),
            F.first("body").alias("body"),
            F.first("dim").alias("dim"),
        ),
        "classes",
    )
    dims = [r.dim for r in classes.select("dim").distinct().collect()]
    lists = {dim: calibrated(dim, cosine) for dim in dims}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cids = batch.column("cid").to_numpy()
            labels = batch.column("label_hash").to_numpy().view(np.uint64)
            bodies = batch.column("body")
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                many = lists[dim][0]
                for part in np.array_split(at, max(1, len(at) // 2000)):
                    body = b"".join(bodies[int(i)].as_py() for i in part)
                    keys = list_keys(np.frombuffer(body).reshape(-1, dim), cosine, many)
                    keys = (keys ^ labels[part][:, None]) * np.uint64(0xD6E8FEB86659FD93)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.ravel().view(np.int64)),
                            pa.array(np.tile(np.arange(many, dtype=np.int32), len(part))),
                            pa.array(np.repeat(cids[part], many)),
                        ],
                        ["key", "nth", "cid"],
                    )

    lists_of = written(
        classes.select("cid", "dim", "body", F.xxhash64("label").alias("label_hash")).mapInArrow(
            index, "key long, nth int, cid long"
        ),
        "lists",
    )
    sizes = lists_of.groupBy("key", "nth").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / F.lit(TILE)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    live = (
        lists_of.join(sizes, ["key", "nth"])
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
        .withColumn("other", other)
        .select(
            "key",
            "nth",
            "cid",
            "tile",
            F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"),
        )
        .join(classes.select("cid", "times", "dim", "body"), "cid")
    )
    found = written(counted_pairs(live, cosine, lists), "pairs")
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("linked"))
    groups = components(found.where("b is not null").select("a", "b"))
    rooted = written(
        classes.join(groups, classes.cid == groups.node, "left")
        .join(counts, classes.cid == counts.a, "left")
        .select(
            "label",
            "same",
            "low_id",
            (F.coalesce("linked", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("root", "cid").alias("root"),
        ),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component"))
    of_class = rooted.join(lowest, "root").select("label", "same", "n_links", "component")
    component = F.coalesce("component", "vec_id")
    return rows.join(of_class, ["label", "same"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
