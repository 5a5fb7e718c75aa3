"""Incremental summaries: random batches against a rebuild, touched parts, replays, failures."""

import random

import pytest
from pyspark.sql import functions as F

from lakecraft.sources import summaries as S

IMAGE = "struct<id:long,region:string,status:string,amount:double,buyer:long>"
SPEC = S.Summary(("region", "status"), "region", {"revenue": "amount"}, {"buyers": "buyer", "amounts": "amount"})


def _changes(spark, rows):
    return spark.createDataFrame(rows, f"op string, before {IMAGE}, after {IMAGE}")


def _rebuilt(live):
    out = {}
    for _, region, status, amount, buyer in live.values():
        g = out.setdefault((region, status), [0, [], set()])
        g[0] += 1
        g[1] += [] if amount is None else [amount]
        g[2] |= set() if buyer is None else {buyer}
    return sorted(((*k, n, sum(a) if a else None, len(b), len(set(a))) for k, (n, a, b) in out.items()), key=str)


def _read(spark, path):
    like = spark.createDataFrame([], "id long, region string, status string, amount double, buyer long")
    df = S.read_summary(spark, path, SPEC, like)
    return df, sorted((tuple(r) for r in df.collect()), key=str)


def _row(rng, i):
    return (i, rng.choice(["n", "s", "w", None, "a/b=c"]), rng.choice(["x", "y", None]), rng.choice([None, 1.25, 2.5, -7.0]), rng.choice([None, 1, 2, 3]))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_a_rebuild(spark, tmp, seed):
    rng, live, path = random.Random(seed), {}, f"{tmp}/s"
    for batch in range(5):
        rows = []
        for _ in range(30):
            i = rng.randint(0, 40)
            if i not in live:
                live[i] = _row(rng, i)
                rows.append(("c", None, live[i]))
            elif rng.random() < .5:
                new = _row(rng, i)
                rows.append(("u", live[i], new))
                live[i] = new
            else:
                rows.append(("d", live.pop(i), None))
        df = _changes(spark, rows)
        assert S.apply_changes(spark, path, SPEC, df, batch) > 0
        assert _read(spark, path)[1] == _rebuilt(live)
        assert S.apply_changes(spark, path, SPEC, df, batch) == 0              # applied before: nothing happens
    if live:
        S.apply_changes(spark, path, SPEC, _changes(spark, [("d", r, None) for r in live.values()]), "last")
    assert _read(spark, path)[1] == []                                         # a summary may become empty
    S.apply_changes(spark, path, SPEC, _changes(spark, [("c", None, (1, "n", "x", 4.0, 9))]), "again")
    assert _read(spark, path)[1] == [("n", "x", 1, 4.0, 1, 1)]


def test_only_touched_parts_are_read_and_written(spark, tmp):
    path = f"{tmp}/s"
    S.apply_changes(spark, path, SPEC, _changes(spark, [("c", None, (i, r, "x", 1.0, i)) for i, r in enumerate("nswn")]), 1)
    seen, stored = [], S._stored
    S._stored = lambda *a: seen.append(stored(*a)) or seen[-1]
    try:
        assert S.apply_changes(spark, path, SPEC, _changes(spark, [("u", (0, "n", "x", 1.0, 0), (0, "w", "x", 2.0, 0))]), 2) == 2
    finally:
        S._stored = stored
    files = {f.split("/")[-2] for df in seen for f in df.inputFiles()}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    read = {r[0] for df in seen for r in df.select("_part").collect()}
    assert read == {"n", "w"} and all("PartitionFilters: [" in p and "_part" in p for p in plans), (files, plans)
    assert {(e.version, e.part) for e in S._entries(spark, path)} == {(1, "n"), (1, "s"), (1, "w"), (2, "n"), (2, "w")}
    assert _read(spark, path)[1] == [("n", "x", 1, 1.0, 1, 1), ("s", "x", 1, 1.0, 1, 1), ("w", "x", 2, 3.0, 2, 2)]


def test_a_failed_batch_does_not_count(spark, tmp):
    path = f"{tmp}/s"
    S.apply_changes(spark, path, SPEC, _changes(spark, [("c", None, (1, "n", "x", 1.0, 1))]), 1)
    with pytest.raises(ValueError):
        S.apply_changes(spark, path, SPEC, _changes(spark, [("d", (2, "n", "z", 1.0, 1), None)]), 2, strict=True)
    bad = _changes(spark, [("c", None, (5, "n", "x", 1.0, 1))]).withColumn(
        "op", F.expr("IF(after.id = 5, CAST(raise_error('stop') AS string), op)"))
    with pytest.raises(Exception, match="stop"):
        S.apply_changes(spark, path, SPEC, bad, 3)
    assert _read(spark, path)[1] == [("n", "x", 1, 1.0, 1, 1)]
    S.apply_changes(spark, path, SPEC, _changes(spark, [("c", None, (2, "n", "x", 2.0, 1)), ("r", None, (3, "n", "x", None, None))]), 3)
    assert _read(spark, path)[1] == [("n", "x", 3, 3.0, 1, 2)]


def test_batches_out_of_order(spark, tmp):
    """Deletes and updates that come before the creates they follow."""
    path = f"{tmp}/s"
    old, new = (1, "n", "x", 1.25, 1), (1, "n", "x", 2.5, 2)
    steps = [[("u", old, new)], [("d", (2, "s", "x", 7.0, 3), None)], [("c", None, (2, "s", "x", 7.0, 3))], [("c", None, old)]]
    for i, rows in enumerate(steps):
        S.apply_changes(spark, path, SPEC, _changes(spark, rows), i)
    assert _read(spark, path)[1] == [("n", "x", 1, 2.5, 1, 1)]


def test_superseded_versions_go(spark, tmp):
    path = f"{tmp}/s"
    for i in range(3):
        S.apply_changes(spark, path, SPEC, _changes(spark, [("c", None, (i, "n", "x", 1.0, i))]), i)
    before = _read(spark, path)[1]
    assert S.drop_superseded(spark, path) == [1, 2]
    assert _read(spark, path)[1] == before
    with pytest.raises(ValueError):
        S.Summary(("a",), "b")


def test_nothing_to_apply(spark, tmp):
    assert S.apply_changes(spark, f"{tmp}/s", SPEC, _changes(spark, []), 1) == 0
    assert _read(spark, f"{tmp}/s")[1] == []
