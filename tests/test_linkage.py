import random

import pytest

from shelfwise.operators import linkage


def plain(points, k):
    """Clusters by merging along all pairs, the nearest first."""
    parent = {key: key for key in points}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = sorted(
        (sum((x - y) * (x - y) for x, y in zip(points[a], points[b], strict=True)), a, b)
        for a in points for b in points if a < b
    )
    left, heights = len(points), []
    for d, a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            heights.append(d**0.5)
            if left > k:
                parent[max(x, y)] = min(x, y)
                left -= 1
            else:
                break
    return {key: find(key) for key in points}


def heights(points):
    return sorted(plain_heights(points))


def plain_heights(points):
    keys = list(points)
    inside, out = {keys[0]}, []
    while len(inside) < len(keys):
        d, new = min(
            (sum((x - y) * (x - y) for x, y in zip(points[a], points[b], strict=True)), b)
            for a in inside for b in keys if b not in inside
        )
        out.append(round(d**0.5, 9))
        inside.add(new)
    return out


def frame(spark, points, dims):
    columns = [f"c{i}" for i in range(dims)]
    schema = "id long, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([(k, *p) for k, p in points.items()], schema).repartition(3), columns


@pytest.mark.parametrize("dims", [1, 3])
def test_labels_and_heights_equal_merging_all_pairs(spark, dims, monkeypatch):
    monkeypatch.setattr(linkage.grid, "SPLIT", 9)
    rng = random.Random(dims)
    points = {}
    for i in range(70):
        middle = rng.choice([0, 4, 40])
        points[i] = tuple(rng.gauss(middle, 1.0) for _ in range(dims))
    df, columns = frame(spark, points, dims)
    rows, merges = linkage.merge_tree(df, "id", columns)
    assert sorted(round(r.height, 9) for r in merges.collect()) == heights(points)
    for k in (1, 3, 7):
        got = linkage.cut(merges, rows.select("point"), k).collect()
        assert {r.point: r.cluster for r in got} == plain(points, k)


def test_awkward_rows(spark):
    rows = [(i, float(x), "n", "m") for i, x in enumerate([0, 0, 0, 1, 9, 9, 20])]
    rows += [(50, None, "n", "m"), (51, float("nan"), "n", "m"), (52, float("inf"), "n", "m"), (None, 1.0, "n", "m")]
    df = spark.createDataFrame(rows, "id long, x double, point_ string, a string")
    got = linkage.single_linkage(df, "id", ["x"], 3)
    assert got.columns == [*df.columns, "cluster"]
    want = {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 4, 6: 6, 50: None, 51: None, 52: None, None: None}
    assert {r.id: r.cluster for r in got.collect()} == want
    assert {r.cluster for r in linkage.single_linkage(df, "id", ["x"], 9).collect()} == {0, 3, 4, 6, None}
    assert linkage.single_linkage(df.limit(0), "id", ["x"], 3).count() == 0
    one = linkage.single_linkage(df.limit(3), "id", ["x"], 2).collect()
    assert {r.cluster for r in one} == {0}
    with pytest.raises(ValueError, match="cluster"):
        linkage.single_linkage(df, "id", ["x"], 0)
