"""Composite jobs: each is one Spark application step built from the library's
readers, operators and writers. Row counts are taken with ``observe`` inside
the write job itself, so no step scans its input twice just to count; steps are
reconciled against each other.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakecraft.operators import cleaning as CL
from lakecraft.operators import warehouse as WH
from lakecraft.sources import files as IO
from lakecraft.sources import sinks as SK
from lakecraft.sources.loads import append_part, latest, publish, read_parts, write_observed


@dataclass
class Metrics:
    steps: dict = field(default_factory=dict)
    failures: dict = field(default_factory=dict)

    def ok(self) -> bool:
        return not self.failures

    def reconcile(self, name: str, expected: int, found: int) -> None:
        """Record a failure where two steps disagree about a number of rows."""
        if expected != found:
            self.failures[name] = f"expected {expected} rows, found {found}"


def run_products(spark: SparkSession, src_csv: str, bronze: str, silver: str, ingest_ts=None) -> Metrics:
    """CSV -> bronze (raw + lineage, appended) -> cleaned products of every
    batch landed so far -> silver Parquet. ``ingest_ts`` only stamps the batch."""
    m = Metrics()
    raw = IO.read_csv_required(spark, src_csv, ["product_name", "category", "price"])
    m.steps["landed"] = write_observed(
        raw.withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_ingest_ts", F.lit(ingest_ts).cast("timestamp") if ingest_ts else F.current_timestamp())
        .withColumn("ingest_date", F.to_date("_ingest_ts")),
        "landed", lambda d: d.write.mode("append").partitionBy("ingest_date").parquet(bronze))
    landed = spark.read.parquet(bronze).select("product_name", "category", "price")
    cleaned = CL.clean_products(landed)
    m.steps["cleaned"] = write_observed(cleaned, "cleaned", lambda d: d.write.mode("overwrite").parquet(silver))
    m.reconcile("silver", m.steps["cleaned"], spark.read.parquet(silver).count())
    return m


def validate_load(spark: SparkSession, path: str, expected_rows: int | None = None,
                  required: tuple = (), where=None) -> dict:
    """Output exists and has rows (or just the expected number of them) and the
    required columns; ``where`` restricts the check to one run's part."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        return {"ok": False, "reason": f"missing output: {e}"}
    missing = sorted(set(required) - set(df.columns))
    n = (df if where is None else df.where(where)).count()
    ok = not missing and (n > 0 if expected_rows is None else n == expected_rows)
    return {"ok": ok, "rows": n, "missing_columns": missing}


def run_orders(spark: SparkSession, orders: DataFrame, out: str, as_of: dt.date, days: int = 30) -> Metrics:
    """Ingest the last ``days`` days of orders -> drop rows missing ids ->
    Parquet by order date (re-runs replace only those days) -> check that the
    run's days hold just the rows of this run. A window without rows is a run
    that loads nothing."""
    m = Metrics()
    first = as_of - dt.timedelta(days=days)
    recent = orders.where(F.col("order_date") >= F.lit(first))
    if recent.isEmpty():
        m.steps.update(extracted=0, rejected=0, loaded=0)
        return m
    obs_in = Observation("orders_in")
    whole = CL.clean_orders(recent).select(F.lit(1))
    counted = recent.observe(obs_in, F.count(F.lit(1)).alias("rows"))
    cleaned = CL.clean_orders(counted, dedup=True).withColumn("order_date", F.to_date("order_date"))
    loaded = write_observed(cleaned, "orders_out", lambda d: d.write.mode("overwrite")
                             .option("partitionOverwriteMode", "dynamic")
                             .partitionBy("order_date").parquet(out))
    extracted = int(obs_in.get["rows"])
    valid = whole.count()
    m.steps.update(extracted=extracted, rejected=extracted - valid, repeated=valid - loaded, loaded=loaded)
    v = validate_load(spark, out, expected_rows=loaded, where=F.col("order_date") >= F.lit(first))
    if not v["ok"]:
        m.failures["validate"] = v
    return m


def run_medallion(spark: SparkSession, bronze_csv: str, silver: str, gold: str,
                  date_col: str = "order_date") -> Metrics:
    """Bronze CSV -> silver Parquet partitioned by day -> gold daily metrics."""
    from lakecraft.plans.dashboards import gold_metrics
    m = Metrics()
    df = IO.read_csv_inferred(spark, bronze_csv)
    clean = CL.clean_silver(df).withColumn(date_col, F.to_date(date_col))
    m.steps["silver"] = write_observed(clean, "silver", lambda d: SK.write_parquet(d, silver, partition_by=[date_col]))
    g = gold_metrics(spark.read.parquet(silver))
    m.steps["gold"] = write_observed(g, "gold", lambda d: d.write.mode("overwrite").parquet(gold))
    return m


def refresh_summary_incremental(rows_for_touched: DataFrame, path: str, partition_by) -> None:
    """Incremental refresh of a partitioned summary: ``rows_for_touched`` holds the recomputed
    rows of the touched partitions; the other partitions' files stay."""
    SK.write_parquet(rows_for_touched, path, partition_by=partition_by)


def load_dimension(spark: SparkSession, rows: DataFrame, path: str, key: str, attrs: list[str], sk: str, as_of: dt.date) -> int:
    """First load, or the changes of ``rows`` applied to the stored versions (SCD2)."""
    _, stored = latest(spark, path)
    if stored is None:
        new = WH.with_surrogate_key(WH.scd2_initial(rows, key, attrs, as_of), [key, "valid_from"], sk)
    else:
        new = WH.scd2_apply(stored, rows, key, attrs, as_of, sk)
    return publish(spark, new, path, sk)


def load_facts(spark: SparkSession, items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, path: str) -> int:
    """Append the facts of items that no earlier load holds; returns their number. Equal items of
    an order are told apart by ``occurrence``."""
    from lakecraft.plans.mart import ITEM_KEY
    numbered = WH.with_occurrence(items, ITEM_KEY)
    stored = read_parts(spark, path)
    if stored is not None:
        numbered = numbered.join(stored.withColumnRenamed("amount", "subtotal").select(*ITEM_KEY, "occurrence"), [*ITEM_KEY, "occurrence"], "left_anti")
    return append_part(spark, WH.fact_sales(numbered, orders, customers, products, keep=["occurrence"]), path, "fact")


def _run_step(m: Metrics, policy: dict, name: str, work: Callable) -> bool:
    """Run a step; False when it failed and was required."""
    try:
        work()
    except Exception as e:                 # the step's policy decides whether the run goes on
        m.failures[name] = f"{type(e).__name__}: {e}"
        return policy.get(name) != "required"
    return True


def run_mart(spark: SparkSession, sf_dir: str, out: str, as_of: dt.date, products_csv: str | None = None,
             steps: dict | None = None) -> Metrics:
    """Product CSV (if given) -> source tables -> mart (SCD2 dimensions, date
    dimension, facts) -> dashboard summaries. Each run applies what changed
    since the last one: dimension versions accumulate, only new items become
    facts. A failed ``required`` step ends the run, an ``optional`` one is
    recorded."""
    from lakecraft.plans import dashboards as DB
    from lakecraft.plans.mart import CUSTOMER_ATTRS, PRODUCT_ATTRS
    from lakecraft.sources import tables as T
    m = Metrics()
    policy = {"products_csv": "required", "mart": "required", "summaries": "optional", **(steps or {})}
    mart = f"{out}/mart"

    def csv():
        got = run_products(spark, products_csv, f"{out}/bronze/products", f"{out}/silver/products")
        m.steps.update({f"products_{k}": v for k, v in got.steps.items()})
        if not got.ok():
            raise ValueError(str(got.failures))

    def tables():
        orders = T.orders(spark, sf_dir)
        m.steps["dim_date"] = publish(spark, WH.dim_date(orders, "order_date", as_of), f"{mart}/dim_date", "dim_date")
        m.steps["dim_customer"] = load_dimension(spark, T.customers(spark, sf_dir), f"{mart}/dim_customer", "customer_id",
                                                 CUSTOMER_ATTRS, "customer_sk", as_of)
        m.steps["dim_product"] = load_dimension(spark, T.products(spark, sf_dir), f"{mart}/dim_product", "product_id",
                                                PRODUCT_ATTRS, "product_sk", as_of)
        m.steps["fact"] = load_facts(spark, T.order_items(spark, sf_dir), orders, latest(spark, f"{mart}/dim_customer")[1],
                                     latest(spark, f"{mart}/dim_product")[1], f"{mart}/fact")
        whole = T.order_items(spark, sf_dir).join(orders.select("order_id"), "order_id", "left_semi").count()
        m.reconcile("fact_rows", whole, read_parts(spark, f"{mart}/fact").count())

    def summaries():
        for name in ("mv_daily_revenue", "mv_top_customers", "mv_revenue_by_category"):
            m.steps[name] = publish(spark, getattr(DB, name)(spark, sf_dir), f"{out}/summaries/{name}", name)

    for name, work in (("products_csv", csv if products_csv else None), ("mart", tables), ("summaries", summaries)):
        if work and not _run_step(m, policy, name, work):
            break
    return m


def run_incremental_items(spark: SparkSession, sf_dir: str, out: str, overlap_days: int = 7) -> Metrics:
    """Items of orders that no earlier run loaded. The bookmark is the highest ``order_date`` in
    ``out``; a run reads the orders from ``overlap_days`` before it on (0: from that day on) and
    leaves out the items stored for those days, so an order that arrives late, on the last loaded
    day or up to ``overlap_days`` before, is loaded once. Each run appends one load."""
    from lakecraft.plans.mart import items_after
    key = ["order_id", "line_number", "order_date", "product_id", "quantity", "subtotal"]
    m = Metrics()
    stored = read_parts(spark, out)
    last = None if stored is None else stored.agg(F.max(F.to_date("order_date"))).first()[0]
    since = None if last is None else last - dt.timedelta(days=overlap_days)
    fresh = WH.with_occurrence(items_after(spark, sf_dir, None if since is None else since - dt.timedelta(days=1)), key)
    if since is not None:
        known = stored.where(F.col("order_date") >= F.lit(since)).select(*key, "occurrence")
        fresh = fresh.join(known, [*key, "occurrence"], "left_anti")
    m.steps["loaded"] = append_part(spark, fresh, out, "items")
    return m


def format_bench(spark: SparkSession, n: int, workdir: str, seed: int = 42) -> dict:
    """Write/read time and size of the same rows as CSV and as Parquet. Reads
    go to the ``noop`` sink so every column of every row is materialised."""
    df = IO.synthetic_products(spark, n, seed)
    out = {"rows": n}
    for fmt in ("csv", "parquet"):
        p = f"{workdir}/bench_{fmt}"
        t0 = time.perf_counter()
        (df.write.mode("overwrite").option("header", True).csv(p) if fmt == "csv"
         else df.write.mode("overwrite").parquet(p))
        out[f"{fmt}_write_sec"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        r = spark.read.option("header", True).schema(df.schema).csv(p) if fmt == "csv" else spark.read.parquet(p)
        r.write.format("noop").mode("overwrite").save()
        out[f"{fmt}_read_sec"] = round(time.perf_counter() - t0, 3)
        out[f"{fmt}_mb"] = round(IO.list_files(spark, p, "*").agg(F.sum("size")).first()[0] / 1e6, 3)
    out["write_speedup"] = round(out["csv_write_sec"] / max(out["parquet_write_sec"], 1e-9), 2)
    out["read_speedup"] = round(out["csv_read_sec"] / max(out["parquet_read_sec"], 1e-9), 2)
    out["size_ratio"] = round(out["csv_mb"] / max(out["parquet_mb"], 1e-9), 2)
    return out
