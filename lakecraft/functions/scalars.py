"""Column-expression helpers. All are built-in Spark expressions (codegen'd,
JVM-side); none is a Python UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must agree with the reference's data model.
OPEN_END_DATE = dt.date(9999, 12, 31)          # SCD2 open validity end
MONEY = "decimal(12,2)"                        # NUMERIC(12,2) amounts
PRICE = "decimal(10,2)"                        # NUMERIC(10,2) prices


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact money value: sums over it are independent of partitioning."""
    return _c(c).cast(MONEY)


def money_sum(c) -> Column:
    """SUM over exact decimals, returned as double (same bits in every engine)."""
    return F.sum(money(c)).cast("double")


def money_avg(c) -> Column:
    """AVG as exact decimal sum / count, one double division (no rounding, so
    every engine returns the same bits)."""
    n = F.count(_c(c))
    return F.when(n > 0, F.sum(money(c)).cast("double") / n.cast("double"))


def ntz(value) -> Column:
    """Zone-less timestamp literal from a ``datetime``/``date`` (parsed from
    text, so the session time zone plays no part)."""
    return F.lit(str(value)).cast("timestamp_ntz")


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_millis(c) -> Column:
    """Milliseconds since 1970-01-01 of a zone-less timestamp (taken as UTC)."""
    return F.expr(f"timestampdiff(MILLISECOND, {_EPOCH}, {c})") if isinstance(c, str) else \
        F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), c)


def from_epoch_millis(c) -> Column:
    """Zone-less timestamp of epoch milliseconds (inverse of :func:`epoch_millis`)."""
    return F.timestamp_add("MILLISECOND", _c(c), F.expr(_EPOCH))


def date_key(d) -> Column:
    """``TO_CHAR(d,'YYYYMMDD')::INT``."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def year_month_key(d) -> Column:
    """``TO_CHAR(d,'YYYYMM')::INT``."""
    return F.date_format(_c(d), "yyyyMM").cast("int")


def iso_dow(d) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday (``weekday`` is 0-based Mon)."""
    return (F.weekday(_c(d)) + 1).cast("int")


def strip_ws(c) -> Column:
    """Strip every kind of leading/trailing whitespace (``str.strip``), not only
    spaces as ``trim`` does."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s+", ""), r"\s+$", "")


# Numeric text that a plain decimal parser accepts: optional sign, digits with an
# optional fraction or a leading-dot fraction, optional exponent; also inf/nan.
_NUMERIC_RE = r"^[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def try_number(c) -> Column:
    """Text -> double, invalid -> null (``pd.to_numeric(errors='coerce')``).

    Spark's own cast also accepts Java suffixes such as ``1d``/``1f``; the regex
    guard rejects those so the result equals a plain decimal parse.
    """
    s = strip_ws(_c(c).cast("string"))
    return F.when(F.lower(s).rlike(_NUMERIC_RE), s.try_cast("double"))


def json_or_raw(c, raw_field: str = "raw") -> Column:
    """Text -> JSON object text; anything that is not a JSON object (plain text,
    malformed JSON, arrays) becomes ``{"raw": text}``."""
    s = _c(c)
    parsed = F.try_parse_json(s)
    is_obj = parsed.isNotNull() & (F.schema_of_variant(parsed).startswith("OBJECT"))
    return F.when(is_obj, F.to_json(parsed)).otherwise(F.to_json(F.struct(s.alias(raw_field))))


def partition_expr(spec: str, ts_or_col) -> Column:
    """Partition transform -> derived column (``month(ts)``, ``day(ts)``,
    ``year``, ``hour``, ``bucket[n]``, ``truncate[n]``, ``identity``)."""
    c = _c(ts_or_col)
    kind, _, arg = spec.partition(":")
    if kind == "identity":
        return c
    if kind == "year":
        return F.year(c)
    if kind == "month":
        return F.date_format(c, "yyyy-MM")
    if kind == "day":
        return F.to_date(c)
    if kind == "hour":
        return F.date_format(c, "yyyy-MM-dd-HH")
    if kind == "bucket":
        return F.pmod(F.xxhash64(c), F.lit(int(arg)))
    if kind == "truncate":
        return F.substring(c.cast("string"), 1, int(arg))
    raise ValueError(f"unknown partition transform {spec!r}")
