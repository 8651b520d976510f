import math
import random
from collections import Counter

import pytest

from shelfwise.operators import cells, density, graph


def plain(points, eps, least):
    """(role, cluster) per row by comparing all rows."""
    def near(a, b):
        return sum((x - y) * (x - y) for x, y in zip(a, b, strict=True)) <= eps * eps

    core = [sum(near(p, q) for _, q in points) >= least for _, p in points]
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, p) in enumerate(points):
        for j in range(i):
            if core[i] and core[j] and near(p, points[j][1]):
                a, b = find(i), find(j)
                parent[a] = b
    name = {}
    for i, (key, _) in enumerate(points):
        if core[i]:
            name[find(i)] = min(key, name.get(find(i), key))
    for i, (_, p) in enumerate(points):
        if core[i]:
            yield "core", name[find(i)]
            continue
        around = [name[find(j)] for j in range(len(points)) if core[j] and near(p, points[j][1])]
        yield ("border", min(around)) if around else ("noise", None)


def check(spark, points, eps, least):
    dims = len(points[0][1])
    columns = [f"c{i}" for i in range(dims)]
    schema = "id long, " + ", ".join(f"{c} double" for c in columns)
    df = spark.createDataFrame([(k, *p) for k, p in points], schema).repartition(4)
    got = density.density_clusters(df, "id", columns, eps, least).collect()
    want = Counter((k, *v) for (k, _), v in zip(points, plain(points, eps, least), strict=True))
    assert Counter((r.id, r.role, r.cluster) for r in got) == want
    return want


@pytest.mark.parametrize(("dims", "seed"), [(1, 1), (2, 2), (3, 3)])
def test_equals_comparison_of_all_rows(spark, dims, seed):
    rng = random.Random(seed)
    points = []
    for i in range(240):
        middle = rng.choice([0.0, 5.0, 9.0])
        spread = rng.choice([0.2, 1.0, 4.0])
        points.append((i, tuple(round(rng.gauss(middle, spread), 2) for _ in range(dims))))
    points += [(300 + i, points[i % 3][1]) for i in range(40)]
    roles = Counter(r for _, r, _ in check(spark, points, 0.8 * math.sqrt(dims), 6))
    assert len(roles) == 3


def test_dense_cells_are_halved_until_they_are_decided(spark, monkeypatch):
    """Two rows of points, nearly one radius apart, in cells of very many points."""
    monkeypatch.setattr(density, "SMALL", 4)
    monkeypatch.setattr(cells, "SPLIT", 7)
    rng = random.Random(8)
    points = []
    for i in range(300):
        x = rng.random() * 3
        points.append((i, (round(x, 4), round(rng.random() * 0.2 + (0 if i % 2 else 1.15), 4))))
    want = check(spark, points, 1.0, 5)
    assert len({c for _, _, c in want}) == 1
    apart = [(k, (x, y + 0.02 if k % 2 else y + 0.3)) for k, (x, y) in points]
    assert len({c for _, _, c in check(spark, apart, 1.0, 5)}) == 2


def test_awkward_rows(spark):
    rows = [(1, 1.0, 2.0, "r"), (2, None, 2.0, "r"), (3, float("nan"), 1.0, "s"), (4, float("inf"), 1.0, None)]
    rows += [(None, 1.0, 2.0, "t"), (6, -0.0, 0.0, "u"), (7, 0.0, -0.0, "u")]
    df = spark.createDataFrame(rows, "id long, a double, b double, role_ string")
    got = density.density_clusters(df, "id", ["a", "b"], 0.5, 2).collect()
    assert len(got) == len(rows)
    assert {r.id: (r.role, r.cluster) for r in got} == {
        1: ("core", 1), None: ("core", 1), 2: (None, None), 3: (None, None), 4: (None, None),
        6: ("core", 6), 7: ("core", 6),
    }
    assert density.density_clusters(df.limit(0), "id", ["a"], 1.0, 2).count() == 0
    with pytest.raises(ValueError, match="radius"):
        density.density_clusters(df, "id", ["a"], 0.0, 2)


def random_graph(seed, n, m):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n), float(rng.randrange(1, 12))) for _ in range(m)]


def reached(n, edges):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    used = []
    for a, b, *w in edges:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            used.append((a, b, *w))
    return {i: find(i) for i in range(n)}, used


@pytest.mark.parametrize(("n", "m"), [(60, 40), (200, 190), (30, 300)])
def test_components_and_spanning_forest(spark, n, m):
    edges = random_graph(m, n, m)
    nodes = spark.range(n).withColumnRenamed("id", "node")
    table = spark.createDataFrame(edges, "a long, b long, weight double")
    got = graph.components(nodes, table)
    assert {r.node: r.root for r in got.collect()} == reached(n, edges)[0]
    ordered = sorted({(w, min(a, b), max(a, b)) for a, b, w in edges if a != b})
    want = reached(n, [(a, b, w) for w, a, b in ordered])[1]
    forest = graph.spanning_forest(table).collect()
    assert sorted((r.a, r.b, r.weight) for r in forest) == sorted(want)


def test_long_paths_and_stars(spark):
    path = [(i, i + 1, 1.0) for i in range(400)] + [(1000, i, 2.0) for i in range(1001, 1200)]
    ids = sorted({x for a, b, _ in path for x in (a, b)})
    nodes = spark.createDataFrame([(i,) for i in ids], "node long")
    table = spark.createDataFrame(path, "a long, b long, weight double")
    got = {r.node: r.root for r in graph.components(nodes, table).collect()}
    assert got == {i: 0 if i <= 400 else 1000 for i in ids}
    assert graph.spanning_forest(table).count() == len(path)
    assert graph.spanning_forest(table.limit(0)).count() == 0
    assert graph.components(nodes, table.limit(0)).where("node = root").count() == len(ids)
