"""Window computations that stay parallel at any data size.

A plain ``row_number() OVER (ORDER BY ...)`` or running ``SUM`` without a
``PARTITION BY`` is executed by Spark in a single task, and a window partitioned
by a low-cardinality or skewed key puts a whole group into one task. The
operators here give the same results on range segments of the full (unique)
ordering key:

1. cut points come from a sample of the (group, order) keys, one key for each
   of a fixed number of hash buckets: a partially aggregated job that writes
   nothing and returns a few keys for each segment;
2. a row's segment is found by binary search among the cuts: a balanced tree
   of compiled comparisons with literals, a pure function of the row, the same
   in every branch of a plan and after every retry;
3. only groups that hold a cut span segments. Their totals per segment - at
   most two rows a segment - give the offset of each segment, and are
   broadcast;
4. the answer is ``segment offset + within-segment value``: one shuffle of the
   rows, on (segment, group). No copy of the rows is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled keys for each segment.
SAMPLE_PER_SEGMENT = 16


@dataclass(frozen=True)
class Desc:
    """A numeric sort column in descending order, nulls last."""
    col: str


def _sort(o) -> Column:
    return F.col(o.col).desc_nulls_last() if isinstance(o, Desc) else F.col(o).asc_nulls_first()


def _ascending(o) -> Column:
    """A value whose natural order is the sort order."""
    return F.struct(F.col(o.col).isNull(), -F.col(o.col)) if isinstance(o, Desc) else F.col(o)


def _num_segments(df: DataFrame, n: int | None) -> int:
    """Explicit, else ``spark.sql.shuffle.partitions`` (sized by the deployment for its data volume)."""
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_segments(df: DataFrame, order: Sequence, group: Sequence[str] = (),
                   num_segments: int | None = None) -> DataFrame:
    """``df`` plus ``_pid`` (number of the row's range segment of group + order)
    and ``_spans`` (whether the row's group holds a cut, that is, may go on in
    a neighbouring segment; a test on the group alone, so it reaches the scan).

    ``order`` (column names or :class:`Desc`) must make rows unique within
    ``group`` (add the primary key as the last sort column).
    """
    n = _num_segments(df, num_segments)
    if n <= 1:
        return df.withColumns({"_pid": F.lit(0), "_spans": F.lit(False)})
    names = list(dict.fromkeys(list(group) + [o.col if isinstance(o, Desc) else o for o in order]))
    cuts = _cut_points(df, names, [F.col(c).asc_nulls_first() for c in group] + [_sort(o) for o in order], n)
    if not cuts:
        return df.withColumns({"_pid": F.lit(0), "_spans": F.lit(False)})

    kinds = {f.name: f.dataType.simpleString() for f in df.select(*names).schema.fields}
    keys = [(c, False) for c in group] + [(o.col, True) if isinstance(o, Desc) else (o, False) for o in order]
    at = {c: i for i, c in enumerate(names)}

    def reached(cut) -> str:
        """Whether the row sorts at or after ``cut``."""
        found = "true"
        for c, descending in reversed(keys):
            name, value = _quoted(c), _literal(cut[at[c]], kinds[c])
            if cut[at[c]] is None:
                after = "false" if descending else f"{name} IS NOT NULL"
            else:
                after = f"coalesce({name} < {value}, true)" if descending else f"coalesce({name} > {value}, false)"
            found = f"({after} OR ({name} <=> {value} AND {found}))"
        return found

    def search(lo: int, hi: int) -> str:      # the number of cuts at or below the row lies in lo..hi
        if lo == hi:
            return str(lo)
        mid = (lo + hi + 1) // 2
        return f"CASE WHEN {reached(cuts[mid - 1])} THEN {search(mid, hi)} ELSE {search(lo, mid - 1)} END"

    groups = list(dict.fromkeys(tuple(cut[:len(group)]) for cut in cuts))
    return df.withColumns({"_pid": F.expr(search(0, len(cuts))), "_spans": F.expr(_one_of(group, groups, kinds))})


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str | None, kind: str) -> str:
    """A value given as text, as a foldable SQL expression of type ``kind`` (the text in hex, so nothing needs escapes)."""
    return f"CAST(NULL AS {kind})" if text is None else f"CAST(CAST(X'{text.encode().hex()}' AS string) AS {kind})"


def _one_of(group: Sequence[str], groups: list[tuple], kinds: dict) -> str:
    """Whether the row's group is one of ``groups``: per column a look-up in a set, which is all for one column."""
    tests = []
    for i, c in enumerate(group):
        known = [_literal(g[i], kinds[c]) for g in groups if g[i] is not None]
        test = f"coalesce({_quoted(c)} IN ({', '.join(dict.fromkeys(known))}), false)" if known else "false"
        tests.append(f"({test} OR {_quoted(c)} IS NULL)" if len(known) < len(groups) else test)
    if len(group) > 1:
        tests.append("(" + " OR ".join("(" + " AND ".join(f"{_quoted(c)} <=> {_literal(v, kinds[c])}" for c, v in zip(group, g)) + ")"
                                       for g in groups) + ")")
    return " AND ".join(tests) or "true"


def _cut_points(df: DataFrame, names: Sequence[str], sort: Sequence[Column], n: int) -> list[tuple]:
    """At most ``n - 1`` keys (as text) that cut ``df`` into segments of about equal size: quantiles of
    the rows with the least hash in each of ``SAMPLE_PER_SEGMENT * n`` hash buckets."""
    h = F.xxhash64(F.lit(17), *names)
    bucket = F.pmod(h, F.lit(SAMPLE_PER_SEGMENT * n))
    sample = df.groupBy(bucket.alias("_b")).agg(F.min(F.struct(h.alias("_h"), *names)).alias("_r")).select("_r.*")
    rows = sample.orderBy(*sort).select(*[F.col(c).cast("string") for c in names]).collect()
    picked = [tuple(rows[len(rows) * i // n]) for i in range(1, n)] if rows else []
    return list(dict.fromkeys(picked))


def segment_edges(seg: DataFrame, group: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """One row per (segment, spanning group): at most two a segment."""
    return seg.where("_spans").groupBy("_pid", *group).agg(*[e.alias(c) for c, e in aggs.items()])


def earlier_segments(group: Sequence[str]) -> Window:
    """Over :func:`segment_edges`: a group's earlier segments."""
    return Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)


def with_segment_edges(seg: DataFrame, edges: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows plus the columns of their (segment, group) edge row, null for groups that don't span."""
    small = edges.select(F.col("_pid").alias("_ep"), *[F.col(c).alias(f"_e{i}") for i, c in enumerate(group)], *cols)
    cond = seg["_pid"] == small["_ep"]
    for i, c in enumerate(group):
        cond = cond & seg[c].eqNullSafe(small[f"_e{i}"])
    return seg.join(F.broadcast(small), cond, "left").drop("_ep", *[f"_e{i}" for i in range(len(group))])


def inside_segment(group: Sequence[str], order: Sequence):
    return Window.partitionBy("_pid", *group).orderBy(*[_sort(o) for o in order])


def prefix_sums(df: DataFrame, values: dict[str, Column], order: Sequence,
                group: Sequence[str] = (), num_segments: int | None = None) -> DataFrame:
    """Running sums ``SUM(v) OVER (PARTITION BY group ORDER BY order ROWS
    UNBOUNDED PRECEDING)`` for each ``out -> value expression`` in ``values``.

    ``order`` must be unique within ``group``; a hot group is spread over
    several segments, so no group is bound to one task.
    """
    group = list(group)
    tmp = {out: f"_v{i}" for i, out in enumerate(values)}
    seg = range_segments(df.withColumns({tmp[o]: e for o, e in values.items()}), order, group, num_segments)
    edges = segment_edges(seg, group, {f"{t}_t": F.sum(t) for t in tmp.values()})
    run = earlier_segments(group)
    edges = edges.select("_pid", *group, *[F.sum(f"{t}_t").over(run).alias(f"{t}_c") for t in tmp.values()])
    within = inside_segment(group, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = with_segment_edges(seg, edges, group, [f"{t}_c" for t in tmp.values()])
    rows = rows.select("*", *[F.sum(t).over(within).alias(f"{t}_in") for t in tmp.values()])
    # SQL SUM is null only while no non-null value has been seen
    done = [F.coalesce(F.col(f"{t}_c") + F.col(f"{t}_in"), F.col(f"{t}_in"), F.col(f"{t}_c")).alias(out) for out, t in tmp.items()]
    return rows.select(*[c for c in df.columns if c not in values], *done)


def global_row_number(df: DataFrame, order: Sequence, out: str = "rn", num_segments: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` computed in parallel; ``order`` is unique over ``df``."""
    return prefix_sums(df, {out: F.lit(1).cast("long")}, order, (), num_segments)


def rank_in_group(df: DataFrame, group: Sequence[str], rank_by: Sequence[str], descending: bool,
                  out: str = "rank", dense: bool = False, num_segments: int | None = None) -> DataFrame:
    """``RANK()`` / ``DENSE_RANK()`` ``OVER (PARTITION BY group ORDER BY rank_by)``.

    Rows are first counted per peer value ``group + rank_by`` (a partially
    aggregated group-by, so hot values cost one row per map task). On that much
    smaller table, a parallel running count gives RANK = rows before the peer
    value + 1 and DENSE_RANK = distinct values up to it; the result is joined
    back on the peer value.
    """
    peers = list(group) + list(rank_by)
    counted = df.groupBy(*peers).agg(F.count(F.lit(1)).alias("_c"))
    running = prefix_sums(counted, {"_cum": F.col("_c"), "_dense": F.lit(1).cast("long")},
                          [Desc(c) if descending else c for c in rank_by], group, num_segments)
    value = F.col("_dense") if dense else F.col("_cum") - F.col("_c") + 1
    ranks = running.select(*peers, value.cast("long").alias(out))
    return _join_on_peers(df, ranks, peers, out)


def _join_on_peers(left: DataFrame, right: DataFrame, peers: Sequence[str], out: str) -> DataFrame:
    """Null-safe equi-join of ``left`` with a one-row-per-peer table ``right``."""
    renamed = right.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(peers)], out)
    cond = [left[c].eqNullSafe(renamed[f"_k{i}"]) for i, c in enumerate(peers)]
    return left.join(renamed, cond).select(*left.columns, out)


def partition_total(df: DataFrame, group: Sequence[str], value: Column, out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY group)``: partially aggregated group-by
    joined back on the key. A hot key is pre-aggregated map-side and its join
    partition is split by AQE's skew-join handling."""
    totals = df.groupBy(*group).agg(F.sum(value).alias(out))
    return df.join(totals, list(group))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
                    out: str = "rn") -> DataFrame:
    """``ROW_NUMBER() ... <= n`` per group. Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so each map task sends at most
    ``n`` rows per group - a hot group never reaches one task whole."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w).cast("long")).where(F.col(out) <= n)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key (``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order
    DESC) = 1``) as one aggregate: ``max(struct(order..., rest...))``.

    The struct ends with every remaining column, so ties are broken by the whole
    row and the result is deterministic. Being an aggregate it is combined
    map-side; a hot key costs one row per map task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_m")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col(f"_m.{c}").alias(c)
                                                      for c in list(order) + rest]) \
        .select(*df.columns)


def lead_in_group(df: DataFrame, group: Sequence[str], order: Sequence, values: dict[str, str],
                  num_segments: int | None = None) -> DataFrame:
    """``LEAD(col) OVER (PARTITION BY group ORDER BY order)`` for each
    ``out -> col`` in ``values``, parallel for hot groups: ``lead`` within a
    segment, and for the last row of a segment's part of a group the first row
    of the group's next part."""
    group = list(group)
    seg = range_segments(df, order, group, num_segments)
    place = F.struct(*[_ascending(o).alias(f"o{i}") for i, o in enumerate(order)])
    packed = F.struct(*[F.col(c).alias(c) for c in values.values()])
    edges = segment_edges(seg, group, {"_first": F.min_by(packed, place)})
    nxt = edges.select("_pid", *group, F.lead("_first").over(Window.partitionBy(*group).orderBy("_pid")).alias("_next"))
    rows = with_segment_edges(seg, nxt, group, ["_next"])
    inside = inside_segment(group, order)
    is_last = F.lead(F.lit(1)).over(inside).isNull()
    return rows.select(*[c for c in df.columns if c not in values],
                       *[F.when(is_last, F.col(f"_next.{c}")).otherwise(F.lead(c).over(inside)).alias(out) for out, c in values.items()])


def carry_forward(df: DataFrame, group: Sequence[str], order: Sequence, carried: str, out: str,
                  num_segments: int | None = None) -> DataFrame:
    """``LAST(carried, ignorenulls) OVER (PARTITION BY group ORDER BY order ROWS
    UNBOUNDED PRECEDING)``: the latest non-null value at or before each row,
    parallel for hot groups."""
    group = list(group)
    seg = range_segments(df, order, group, num_segments)
    place = F.struct(*[_ascending(o).alias(f"o{i}") for i, o in enumerate(order)])
    edges = segment_edges(seg, group, {"_lv": F.max_by(F.col(carried), F.when(F.col(carried).isNotNull(), place))})
    prior = edges.select("_pid", *group, F.last("_lv", ignorenulls=True).over(earlier_segments(group)).alias("_prior"))
    rows = with_segment_edges(seg, prior, group, ["_prior"])
    upto = inside_segment(group, order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*[c for c in df.columns if c != out],
                       F.coalesce(F.last(carried, ignorenulls=True).over(upto), F.col("_prior")).alias(out))
