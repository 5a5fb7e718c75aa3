import datetime as dt

from pyspark.sql import functions as F

from lakecraft.operators import warehouse as WH
from lakecraft.plans.params import AS_OF

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _dim(spark):
    src = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id long, email string")
    base = WH.scd2_initial(src, "id", ["email"], D(2024, 1, 1))
    return WH.with_surrogate_key(base, ["id", "valid_from"], "sk")


def test_scd2_change_fixture(spark):
    dim = _dim(spark)
    inc = spark.createDataFrame([(1, "a2@x"), (2, "b@x"), (3, "c@x")], "id long, email string")
    out = WH.scd2_apply(dim, inc, "id", ["email"], D(2024, 2, 1), sk="sk")
    got = rows(out, "id", "email", "valid_from", "valid_to", "is_current")
    end = D(9999, 12, 31)
    assert got == sorted([(1, "a@x", D(2024, 1, 1), D(2024, 2, 1), False),
                          (1, "a2@x", D(2024, 2, 1), end, True),
                          (2, "b@x", D(2024, 1, 1), end, True),
                          (3, "c@x", D(2024, 2, 1), end, True)])
    sks = [r.sk for r in out.collect()]
    assert sorted(sks) == [1, 2, 3, 4]                    # new versions after max(sk)
    again = WH.scd2_apply(out, inc, "id", ["email"], D(2024, 2, 1), sk="sk")
    assert rows(again, "sk", "id", "email", "valid_from", "valid_to", "is_current") == \
        rows(out, "sk", "id", "email", "valid_from", "valid_to", "is_current")


def test_scd2_null_changes(spark):
    src = spark.createDataFrame([(1, None), (2, "x")], "id long, email string")
    dim = WH.scd2_initial(src, "id", ["email"], D(2024, 1, 1))
    inc = spark.createDataFrame([(1, None), (2, None)], "id long, email string")
    out = WH.scd2_apply(dim, inc, "id", ["email"], D(2024, 3, 1))
    assert out.where("id = 1").count() == 1               # null -> null: no change
    assert out.where("id = 2").count() == 2               # value -> null: a change


def test_scd1_and_scd6(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, name string, other string")
    inc = spark.createDataFrame([(2, "b2"), (3, "c")], "id long, name string")
    out = WH.scd1_apply(dim, inc, "id", ["name"])
    assert rows(out, "id", "name", "other") == [(1, "a", "x"), (2, "b2", "y"), (3, "c", None)]
    d2 = _dim(spark)
    inc2 = spark.createDataFrame([(1, "a2@x")], "id long, email string")
    out6 = WH.scd6_apply(d2, inc2, "id", ["email"], D(2024, 2, 1), ["email"], sk="sk")
    assert rows(out6.where("id = 1"), "email", "current_email") == [("a2@x", "a2@x"), ("a@x", "a2@x")]


def test_insert_ignore_idempotent_and_upsert(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    inc = spark.createDataFrame([(1, "z"), (2, "b"), (2, "b")], "k long, v string")
    new = WH.insert_ignore(target, inc, ["k"])
    assert rows(new, "k", "v") == [(2, "b")]
    after = target.unionByName(new)
    assert WH.insert_ignore(after, inc, ["k"]).count() == 0      # second run appends nothing
    up = WH.upsert(target, inc, ["k"])
    assert rows(up, "k", "v") == [(1, "z"), (2, "b")]


def test_dim_date_shape(spark):
    o = spark.createDataFrame([(D(2025, 1, 26),), (D(2025, 1, 31),)], "order_date date")
    dd = WH.dim_date(o, "order_date", AS_OF)
    assert dd.count() == (D(2026, 1, 31) - D(2024, 1, 26)).days + 1
    r = dd.where(F.col("date_actual") == D(2025, 1, 26)).first()
    assert (r.date_key, r.year, r.month, r.day_of_week, r.day_of_month, r.quarter, r.year_month) == \
        (20250126, 2025, 1, 7, 26, 1, 202501)                      # a Sunday is 7


def test_validity_lookup(spark):
    dim = spark.createDataFrame([(1, "old", D(2024, 1, 1), D(2024, 2, 1)), (1, "new", D(2024, 2, 1), D(9999, 12, 31))],
                                "id long, name string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(1, D(2024, 1, 31)), (1, D(2024, 2, 1))], "id long, d date")
    out = WH.validity_lookup(facts, dim, "id", "d", ["name"])
    assert rows(out, "d", "name") == [(D(2024, 1, 31), "old"), (D(2024, 2, 1), "new")]


def test_scd2_same_day_change_replaces_in_place(spark):
    dim = _dim(spark)
    b1 = spark.createDataFrame([(1, "a2@x")], "id long, email string")
    d1 = WH.scd2_apply(dim, b1, "id", ["email"], D(2024, 2, 1), sk="sk")
    b2 = spark.createDataFrame([(1, "a3@x")], "id long, email string")
    d2 = WH.scd2_apply(d1, b2, "id", ["email"], D(2024, 2, 1), sk="sk")
    got = rows(d2.where("id = 1"), "sk", "email", "valid_from", "valid_to", "is_current")
    sk_open = [r.sk for r in d1.where("id = 1 AND is_current").collect()][0]
    assert got == sorted([(1, "a@x", D(2024, 1, 1), D(2024, 2, 1), False),
                          (sk_open, "a3@x", D(2024, 2, 1), D(9999, 12, 31), True)])


def _versions(df, key=1):
    return rows(df.where(f"id = {key}"), "email", "valid_from", "valid_to", "is_current")


def test_scd2_back_dated_batch(spark):
    end = D(9999, 12, 31)
    one = lambda email: spark.createDataFrame([(1, email)], "id long, email string")
    dim = WH.scd2_apply(_dim(spark), one("march@x"), "id", ["email"], D(2024, 3, 1), sk="sk")
    late = WH.scd2_apply(dim, one("feb@x"), "id", ["email"], D(2024, 2, 1), sk="sk")
    assert _versions(late) == sorted([("a@x", D(2024, 1, 1), D(2024, 2, 1), False), ("feb@x", D(2024, 2, 1), D(2024, 3, 1), False),
                                      ("march@x", D(2024, 3, 1), end, True)])
    assert sorted(r.sk for r in late.collect()) == [1, 2, 3, 4]
    assert rows(WH.scd2_apply(late, one("feb@x"), "id", ["email"], D(2024, 2, 1), sk="sk"), *late.columns) == rows(late, *late.columns)
    # before the first version, inside one with equal attributes, and a replaced closed version
    first = WH.scd2_apply(late, one("old@x"), "id", ["email"], D(2023, 1, 1), sk="sk")
    assert _versions(first)[-1] == ("old@x", D(2023, 1, 1), D(2024, 1, 1), False)
    assert WH.scd2_apply(late, one("feb@x"), "id", ["email"], D(2024, 2, 15), sk="sk").count() == late.count()
    swapped = WH.scd2_apply(late, one("feb2@x"), "id", ["email"], D(2024, 2, 1), sk="sk")
    assert _versions(swapped) == sorted([("a@x", D(2024, 1, 1), D(2024, 2, 1), False), ("feb2@x", D(2024, 2, 1), D(2024, 3, 1), False),
                                         ("march@x", D(2024, 3, 1), end, True)])


def test_scd2_random_batches_never_overlap(spark):
    import random
    rng = random.Random(4)
    dim, want = _dim(spark), {1: {D(2024, 1, 1): "a@x"}, 2: {D(2024, 1, 1): "b@x"}}
    for _ in range(6):
        day = D(2024, rng.randint(1, 6), 1)
        inc = [(k, f"v{rng.randint(0, 2)}") for k in (1, 2, 3) if rng.random() < .8]
        dim = WH.scd2_apply(dim, spark.createDataFrame(inc or [(1, "v0")], "id long, email string"), "id", ["email"], day, sk="sk").cache()
        for k, v in inc or [(1, "v0")]:
            before = [d for d in want.setdefault(k, {}) if d <= day]
            if not before or want[k][max(before)] != v:
                want[k][day] = v
    got = dim.collect()
    assert len({r.sk for r in got}) == len(got)
    for k, v in want.items():
        mine = sorted((r.valid_from, r.email, r.valid_to, r.is_current) for r in got if r.id == k)
        days = sorted(v)
        ends = days[1:] + [D(9999, 12, 31)]
        assert mine == [(d, v[d], e, e == D(9999, 12, 31)) for d, e in zip(days, ends)]


def test_scd2_null_is_current_counts_by_dates(spark):
    dim = _dim(spark).withColumn("is_current", F.lit(None).cast("boolean"))
    out = WH.scd2_apply(dim, spark.createDataFrame([(1, "n@x")], "id long, email string"), "id", ["email"], D(2024, 5, 1), sk="sk")
    assert out.count() == 3 and out.where("is_current").count() == 2


def test_scd2_plan_grows_by_a_constant(spark):
    dim, sizes, plain = _dim(spark), [], []
    for month in range(2, 6):
        batch = spark.createDataFrame([(1, f"v{month}"), (month, "n")], "id long, email string")
        dim = WH.scd2_apply(dim, batch, "id", ["email"], D(2024, month, 1), sk="sk")
        sizes.append(len(dim._jdf.queryExecution().analyzed().toString().splitlines()))
    assert max(sizes) <= sizes[0] + 5
    dim = WH.scd2_initial(spark.createDataFrame([(1, "a")], "id long, email string"), "id", ["email"], D(2024, 1, 1))
    for month in range(2, 6):
        dim = WH.scd2_apply(dim, spark.createDataFrame([(1, f"v{month}")], "id long, email string"), "id", ["email"], D(2024, month, 1))
        plain.append(len(dim._jdf.queryExecution().analyzed().toString().splitlines()))
    steps = [b - a for a, b in zip(plain, plain[1:])]
    assert max(steps) <= min(steps) + 5


def test_validity_lookup_of_a_hot_key(spark):
    """A third of all facts and 10,000 versions on one key: swept, never paired."""
    day = F.expr("date_add(DATE '1990-01-01', CAST(id AS int))")
    dim = spark.range(10_000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"), day.alias("valid_from"),
                                     F.date_add(day, 1).alias("valid_to")).where("v % 10 <> 3")
    dim = dim.unionByName(spark.range(40).where("id <> 7").selectExpr("id AS k", "-id AS v", "DATE '1990-01-01' AS valid_from", "DATE '9999-12-31' AS valid_to"))
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("k"),
                                       F.expr("date_add(DATE '1989-12-30', CAST(id % 10010 AS int))").alias("d"), F.col("id").alias("f"))
    facts = facts.unionByName(facts.limit(3)).unionByName(spark.createDataFrame([(None, D(2000, 1, 1), -1), (7, None, -2)], facts.schema))
    got = WH.validity_lookup(facts, dim, "k", "d", ["v"])
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    v, f = dim.toPandas(), facts.toPandas()
    starts = {(int(a), b): int(c) for a, b, c in zip(v.k, v.valid_from, v.v)}
    others = {int(a): int(c) for a, c in zip(v.k, v.v) if a != 7}

    def want(k, d):
        if k != k or d is None or k not in {7, *others} or d < D(1990, 1, 1):
            return None
        return starts.get((7, d)) if k == 7 else others[int(k)]

    expect = sorted((int(i), want(k, d)) for k, d, i in zip(f.k, f.d, f.f))
    assert sorted((r.f, r.v) for r in got.collect()) == expect


def test_equal_items_are_facts_of_their_own(spark):
    items = spark.createDataFrame([(1, 1, 5, "x", 2, 10.0)] * 2 + [(1, 2, 5, "x", 1, 5.0)],
                                  "order_id long, line_number long, product_id long, created_at string, quantity long, subtotal double")
    orders = spark.createDataFrame([(1, 9, D(2024, 1, 1))], "order_id long, customer_id long, order_date date")
    dc = spark.createDataFrame([(9, 1, True)], "customer_id long, customer_sk long, is_current boolean")
    dp = spark.createDataFrame([(5, 1, True)], "product_id long, product_sk long, is_current boolean")
    assert WH.fact_sales(items, orders, dc, dp).count() == 3
    numbered = WH.with_occurrence(items, items.columns)
    assert rows(numbered, "line_number", "occurrence") == [(1, 1), (1, 2), (2, 1)]
