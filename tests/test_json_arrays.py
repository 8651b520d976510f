import json
import random
from collections import Counter

import pytest

from shelfwise.sources import json_arrays

SIGNS = ["a", "é", "漢", '"', "\\", "{", "}", "[", "]", ",", ":", "\n", "\t", " ", "}{", '\\"', " "]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([None, True, False, 0, -1.5, 12345678901])
    if kind < 4:
        return "".join(rng.choices(SIGNS, k=rng.randrange(9)))
    if kind < 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"".join(rng.choices(SIGNS, k=3)): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def as_rows(records):
    """What a row holds: text of objects, arrays and numbers, plain strings, null."""
    return Counter(
        r if isinstance(r, str) or r is None else json.dumps(r, sort_keys=True) for r in records
    )


def normal(rows, records):
    strings = {r for r in records if isinstance(r, str)}
    out = Counter()
    for r in rows:
        if r is None or r in strings:
            out[r] += 1
        else:
            out[json.dumps(json.loads(r), sort_keys=True)] += 1
    return out


@pytest.fixture
def short_ranges(spark):
    """Ranges of a few dozen bytes, so that most records lie across some."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("seed", "indent", "sent"), [(1, None, 1000), (2, 1, 1000), (3, 3, 0)])
def test_records_across_ranges(spark, tmp_path, short_ranges, monkeypatch, seed, indent, sent):
    monkeypatch.setattr(json_arrays, "SENT_RANGES", sent)
    rng = random.Random(seed)
    records = []
    for i in range(3):
        own = [{"id": i, "x": value(rng)} if rng.random() < 0.6 else value(rng) for _ in range(12)]
        own.append({"long": "{[,\"" * 60})
        records += own
        text = json.dumps(own, indent=indent, ensure_ascii=i % 2 == 0)
        (tmp_path / f"{i}.json").write_text(text + rng.choice(["", "\n", " \n\n"]))
    (tmp_path / "none.json").write_text(" [ ]")
    got = json_arrays.read_elements(spark, str(tmp_path))
    assert got.columns == ["raw"]
    assert normal([r.raw for r in got.collect()], records) == as_rows(records)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, short_ranges):
    (tmp_path / "a.json").write_text(json.dumps([{"n": i} for i in range(200)]))
    texts = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert texts.rdd.getNumPartitions() > 20
    got = json_arrays.read_elements(spark, str(tmp_path))
    assert sorted(json.loads(r.raw)["n"] for r in got.collect()) == list(range(200))


@pytest.mark.parametrize("text", ["  ", '{"a": 1}', "5", '"[1]"'])
def test_files_without_an_array_are_refused(spark, tmp_path, text):
    (tmp_path / "good.json").write_text("[1]")
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(ValueError, match="JSON array"):
        json_arrays.read_elements(spark, str(tmp_path))


def test_array_ends_the_file(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "a.json").write_text('[1, "x", null, [2, {"a": "]"}], {}] ')
    rows = [r.raw for r in json_arrays.read_elements(spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted(["1", "x", None, '[2, {"a": "]"}]', "{}"], key=str)
