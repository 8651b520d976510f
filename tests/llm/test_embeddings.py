import helpers
import numpy as np
import pytest

from shelfwise.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.98):
    links, count = [], [0] * len(rows)
    unit = []
    for _, e, label in rows:
        ok = label is not None and e is not None and len(e) and None not in e
        x = np.array(e, dtype=np.float64) if ok else None
        good = ok and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.linalg.norm(x) if good else None)
    for i, x in enumerate(unit):
        for j in range(i):
            y = unit[j]
            if x is None or y is None or rows[i][2] != rows[j][2] or len(x) != len(y):
                continue
            if float(x @ y) >= cosine - 1e-12:
                links.append((j, i))
                count[i] += 1
                count[j] += 1
    root = helpers.groups_of(links, range(len(rows)))
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root[i]] = min(low.get(root[i], r[0]), r[0])
    return [(r[0], count[i], low.get(root[i]), low.get(root[i]) == r[0] and r[0] is not None) for i, r in enumerate(rows)]


def check(rows, got):
    have = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str)
    assert have == sorted(plain(rows), key=str)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.1"])
def test_query_equals_brute_force(spark, name):
    sf = f"/root/testdata/{name}"
    got = queries.QUERIES["op6_embedding_near_dedup"](spark, sf).collect()
    check(helpers.table(sf, "embeddings", "vec_id, embedding, label"), got)


@pytest.mark.parametrize("dim", [2, 8, 64, 200])
def test_planted_neighbours(spark, dim):
    rng = np.random.default_rng(dim)
    rows = []
    for group in range(60):
        x = rng.normal(size=dim)
        x /= np.linalg.norm(x)
        for _ in range(rng.integers(1, 7)):
            step = rng.normal(size=dim)
            step -= (step @ x) * x
            step /= np.linalg.norm(step)
            c = rng.choice([0.97, 0.9795, 0.9805, 0.981, 0.99, 1.0])
            y = (c * x + np.sqrt(1 - c * c) * step) * rng.choice([1.0, 0.5, 30.0])
            rows.append((len(rows), y.astype(np.float32).tolist(), int(group % 3)))
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)


def test_a_hot_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=32)
    rows = [(i, x.astype(np.float32).tolist(), 1) for i in range(300)]
    for i in range(300, 2800):
        rows.append((i, (x + 0.05 * rng.normal(size=32)).astype(np.float32).tolist(), 1))
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)


def test_awkward_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, one, None), (5, one, 2),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 0.0], 1),
        (10, [float("nan"), 0.0, 0.0], 1), (11, [float("inf"), 0.0, 0.0], 1), (None, one, 1),
        (None, None, None), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0, 0.0], 1), (14, [1e30, 1e25, 0.0], 1),
        (None, [0.0, 1.0, 0.0], 7),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cid int, body string")
    check(rows, embeddings.near_vectors(table).collect())
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_calibration_reaches_the_recall():
    lists, least = embeddings.calibrated(64, 0.98)
    assert 40 <= lists <= 80 and 50 <= least <= 80
