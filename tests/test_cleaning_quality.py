import pytest
from pyspark.sql import functions as F

from lakecraft.operators import cleaning as CL
from lakecraft.operators import quality as Q
from lakecraft.sources import files as IO
from tests.fixtures import ORDERS, PRODUCTS_CSV


@pytest.fixture()
def products_csv(tmp):
    p = f"{tmp}/products.csv"
    with open(p, "w") as f:
        f.write(PRODUCTS_CSV)
    return p


def test_clean_products_sample(spark, products_csv):
    df = IO.read_csv_required(spark, products_csv, ["product_name", "category", "price"])
    out = CL.clean_products(df)
    assert out.count() == 9
    trim = out.where(F.col("product_name") == "Trim Me").first()
    assert (trim.category, trim.price) == ("Laptop", 15000000.0)
    assert dict(out.dtypes)["price"] == "double"


def test_clean_silver_sample(spark, products_csv):
    df = IO.read_csv_inferred(spark, products_csv)
    out = CL.clean_silver(df)
    assert out.count() == 10
    dirty = out.where(F.col("product_name") == "Dirty Product").first()
    assert dirty.category is None and dirty.price is None


def test_read_csv_errors(spark, tmp):
    with pytest.raises(IO.ValidationError):
        IO.read_csv_required(spark, f"{tmp}/missing.csv", ["a"])
    p = f"{tmp}/wrong.csv"
    open(p, "w").write("a,b\n1,2\n")
    with pytest.raises(IO.ValidationError):
        IO.read_csv_required(spark, p, ["product_name"])
    e = f"{tmp}/header_only.csv"
    open(e, "w").write("product_name,category,price\n")
    with pytest.raises(IO.ValidationError):
        IO.read_csv_required(spark, e, ["product_name"])


@pytest.mark.parametrize("price,kept", [("100", True), ("-1", False), ("NaN", False), ("1d", False),
                                        ("abc", False), (" 2.5 ", True), ("1e3", True)])
def test_price_coercion(spark, price, kept):
    df = spark.createDataFrame([("x", "c", price)], "product_name string, category string, price string")
    assert (CL.clean_products(df).count() == 1) == kept


def test_clean_rules(spark):
    df = spark.createDataFrame([("\ta\t", None, "1"), (None, "c", "2"), ("b", "c", None), ("b", "c", "1.0"),
                                ("b", "c", "1")], "product_name string, category string, price string")
    out = sorted((r.product_name, r.category, r.price) for r in CL.clean_products(df).collect())
    assert out == [("a", "", 1.0), ("b", "c", 1.0)]
    empty = spark.createDataFrame([(None, None, None)], "product_name string, category string, price string")
    assert CL.clean_products(empty).count() == 0 and len(CL.clean_products(empty).columns) == 3


def _orders_f4(spark):
    return spark.createDataFrame(
        [(1, 1, "2025-01-01", 100.0, "created"), (2, 1, "2025-01-02", 200.0, "confirmed"),
         (3, 2, "2025-01-03", 150.0, "created")],
        "order_id int, customer_id int, order_date string, total_amount double, status string")


RULES = [Q.NotNull("order_id"), Q.NotNull("customer_id"),
         Q.InSet("status", ["created", "confirmed", "shipped", "cancelled"]),
         Q.Between("total_amount", 0, 1e9), Q.RowCountBetween(1, 1_000_000)]


def test_suite_passes_on_sample(spark):
    rep = Q.run_suite(_orders_f4(spark), RULES)
    assert rep.count() == 5 and all(r.success for r in rep.collect())


def test_suite_status_fails_then_mostly(spark):
    o = spark.createDataFrame([(i, c, s) for i, c, _, s in ORDERS], "order_id long, customer_id long, status string")
    rep = {r.rule: r for r in Q.run_suite(o, [Q.InSet("status", ["created", "confirmed"])]).collect()}
    r = rep["expect_column_values_to_be_in_set"]
    assert (r.unexpected_count, r.success) == (3, False)
    rep2 = Q.run_suite(o, [Q.InSet("status", ["created", "confirmed"], mostly=0.4)]).first()
    assert rep2.success
    with pytest.raises(Q.QualityError):
        Q.run_suite(o, [Q.InSet("status", ["created"])], raise_on_failure=True)


def test_clean_orders(spark):
    df = spark.createDataFrame([("1", "1"), ("", "2"), ("3", None), ("1", "1")], "order_id string, customer_id string")
    assert CL.clean_orders(df).count() == 2
    assert CL.clean_orders(df, dedup=True).count() == 1


def test_profile_and_overall_success(spark):
    from tests.conftest import SF_SMALL
    from lakecraft.sources import tables as T
    o = T.orders(spark, SF_SMALL)
    prof = {r.column: r for r in Q.profile(o, ["order_id", "status"], approx_distinct=True).collect()}
    n = o.count()
    assert prof["order_id"].n_rows == n and prof["order_id"].n_null == 0
    assert abs(prof["order_id"].approx_distinct - n) <= 0.15 * n    # HLL, rsd 0.05: 3 sigma
    assert prof["status"].approx_distinct == 3
    rep = Q.run_suite(o, [Q.NotNull("order_id"), Q.InSet("status", ["F", "O"])])
    assert rep.agg(Q.suite_success(rep)).first()[0] is False
    assert Q.required_columns(o, ["order_id", "nope"]) == ["nope"]


def test_validate_load(spark, tmp):
    from lakecraft.jobs import validate_load
    assert validate_load(spark, f"{tmp}/missing")["ok"] is False
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp}/out")
    assert validate_load(spark, f"{tmp}/out", expected_rows=1, required=("a",))["ok"]
    assert validate_load(spark, f"{tmp}/out", expected_rows=2)["ok"] is False


def test_clean_silver_query_meets_nan(spark, monkeypatch):
    from lakecraft.plans import loads
    from tests.conftest import SF_SMALL
    made, clean = [], loads.CL.clean_silver
    monkeypatch.setattr(loads.CL, "clean_silver", lambda df: made.append(clean(df)) or made[0])
    out = loads.clean_silver(spark, SF_SMALL)
    assert made[0].where("isnan(price)").count() > 0            # the operator keeps NaN
    assert out.where("isnan(price)").count() == 0 < out.where("price IS NULL").count()
