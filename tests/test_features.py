import datetime as dt

from lakecraft.operators import features as FS

TS = dt.datetime


def test_as_of_ttl_golden(spark):
    feats = spark.createDataFrame([(1, 350.0, 3, TS(2025, 1, 1, 12)), (2, 200.0, 2, TS(2025, 1, 2, 12)),
                                   (3, 150.0, 1, TS(2025, 1, 3, 12))],
                                  "customer_id int, total_amount double, order_count long, event_timestamp timestamp")
    req = spark.createDataFrame([(1, TS(2025, 1, 1, 18)), (1, TS(2025, 1, 5)), (2, TS(2025, 1, 1))],
                                "customer_id int, ts timestamp")
    out = FS.as_of_join(req, feats, "customer_id", "ts", "event_timestamp", ["total_amount", "order_count"],
                        dt.timedelta(days=1))
    got = sorted((r.customer_id, r.ts, r.total_amount) for r in out.collect())
    assert got == [(1, TS(2025, 1, 1, 18), 350.0), (1, TS(2025, 1, 5), None), (2, TS(2025, 1, 1), None)]


def test_feature_view_validate(spark):
    src = spark.createDataFrame([(1, 1.0, 1, TS(2025, 1, 1))],
                                "customer_id int, total_amount double, order_count long, event_timestamp timestamp")
    fv = FS.FeatureView("customer_features", "customer_id", "event_timestamp", dt.timedelta(days=1),
                        {"total_amount": "double", "order_count": "bigint"})
    assert fv.validate(src) == []
    assert fv.validate(src.drop("order_count")) == ["missing column order_count"]


def test_materialize_and_lookup(spark):
    f = spark.createDataFrame([(1, 1.0, TS(2025, 1, 1)), (1, 2.0, TS(2025, 1, 3)), (2, 5.0, TS(2024, 12, 1))],
                              "customer_id int, total_amount double, event_timestamp timestamp")
    latest = FS.materialize_latest(f, "customer_id", "event_timestamp", None, TS(2025, 1, 4))
    assert sorted((r.customer_id, r.total_amount) for r in latest.collect()) == [(1, 2.0), (2, 5.0)]
    ents = spark.createDataFrame([(1,), (2,), (3,)], "customer_id int")
    got = FS.lookup(ents, latest, "customer_id", "event_timestamp", ["total_amount"], TS(2025, 1, 4),
                    dt.timedelta(days=2))
    assert sorted((r.customer_id, r.total_amount) for r in got.collect()) == [(1, 2.0), (2, None), (3, None)]


def test_incremental_materialization_equals_full(spark):
    from lakecraft.plans.features import build_customer_features
    from tests.conftest import SF_SMALL
    f = build_customer_features(spark, SF_SMALL)
    t1, t2 = TS(1999, 1, 1), TS(2001, 8, 2)
    s1 = FS.materialize_incremental(None, f, "customer_id", "event_timestamp", None, t1)
    s2 = FS.materialize_incremental(s1, f, "customer_id", "event_timestamp", t1, t2)
    full = FS.materialize_latest(f, "customer_id", "event_timestamp", None, t2)
    key = lambda d: sorted(tuple(r) for r in d.select(*full.columns).collect())
    assert key(s2) == key(full)
