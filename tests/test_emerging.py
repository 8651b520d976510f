import datetime
import random
from collections import Counter


from shelfwise.streaming import emerging

SCHEMA = "product long, at timestamp, value double"
START = datetime.datetime(2024, 1, 4)  # a week's first day


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def rows_in_week(rng, week, n):
    begin = START + datetime.timedelta(days=7 * week)
    return [
        (rng.randrange(9), begin + datetime.timedelta(minutes=rng.randrange(10_080)), rng.randrange(500) / 100)
        for _ in range(n)
    ]


def run(spark, folder, path, late_days=14, **options):
    return emerging.run_emerging(
        spark, folder, SCHEMA, "product", "at", "value", late_days, path=path, **options
    )


def plain(rows, top=5):
    """(week, product, records, cents, previous, rank) of the fastest growing."""
    n, cents = Counter(), Counter()
    for product, at, value in rows:
        key = (at - datetime.datetime(1970, 1, 1)).days // 7, str(product)
        n[key] += 1
        cents[key] += round((value or 0) * 100)
    out = set()
    for week in {w for w, _ in n}:
        order = sorted(
            ((n[week - 1, p] - c, -c, p) for (w, p), c in n.items() if w == week and c > n[week - 1, p])
        )
        for rank, (_, c, p) in enumerate(order[:top], 1):
            out.add((week, p, -c, cents[week, p], n[week - 1, p], rank))
    return out


def found(result):
    return {(r.week, r["product"], r.records, r.cents, r.previous, r["rank"]) for r in result.top.collect()}


def test_files_out_of_order_and_a_second_run(spark, tmp_path):
    rng = random.Random(4)
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    rows = []
    for week in (1, 0, 3, 2):
        part = rows_in_week(rng, week, 60)
        rows += part
        write(spark, folder, part)
    first = run(spark, folder, path)
    assert found(first) == plain(rows) and first.late == 0
    for week in (5, 4, 7):
        part = rows_in_week(rng, week, 60)
        rows += part
        write(spark, folder, part)
    second = run(spark, folder, path)
    assert found(second) == plain(rows) and second.late == 0
    base = (START - datetime.datetime(1970, 1, 1)).days // 7
    is_open = {r.week - base: r.is_open for r in second.weeks.collect()}
    # The newest week begins in week 7; weeks that ended two weeks before it are closed.
    assert is_open == {0: False, 1: False, 2: False, 3: False, 4: False, 5: True, 7: True}
    assert second.weeks.groupBy("product", "week").count().where("count > 1").isEmpty()


def test_late_rows_are_counted(spark, tmp_path):
    rng = random.Random(5)
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    early, later = rows_in_week(rng, 0, 40), rows_in_week(rng, 4, 40)
    write(spark, folder, early)
    write(spark, folder, later)
    assert run(spark, folder, path, 7).late == 0
    write(spark, folder, rows_in_week(rng, 0, 13) + rows_in_week(rng, 4, 0))
    result = run(spark, folder, path, 7)
    assert result.late == 13 and found(result) == plain(early + later)


def test_awkward_rows(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    at = START + datetime.timedelta(hours=1)
    rows = [(None, at, 1.0), (None, at, None), (3, None, 5.0), (3, at, 0.005), (3, at, 0.005)]
    write(spark, folder, rows)
    result = run(spark, folder, path)
    got = {(r["product"], r.records, r.cents, r.is_open) for r in result.weeks.collect()}
    assert got == {(None, 2, 100, True), ("3", 2, 2, True)} and result.late == 0


def test_counts_are_added_up_before_the_shuffle(spark):
    rows = [(1, START, 1.0)] * 5000 + [(2, START, 1.0)]
    partial = emerging.partial_counts(spark.createDataFrame(rows, SCHEMA).coalesce(1), "product", "at", "value")
    assert sorted((r["product"], r.records, r.cents) for r in partial.collect()) == [("1", 5000, 500_000), ("2", 1, 100)]
