"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; there is no Python UDF in the library.  All
divisions go through ``try_divide`` because ANSI mode (on by default in Spark 4)
raises on a zero divisor where pandas would give inf / NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series_window(key: str = "coin_id", order: str = "event_date") -> WindowSpec:
    """One ordered window per entity; every feature shares it, so the plan has a
    single Exchange + Sort for all of them."""
    return Window.partitionBy(key).orderBy(order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """Frame of the current row and the ``n - 1`` rows before it (row based)."""
    return w.rowsBetween(-(n - 1), 0)


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.try_divide(col(a), col(b))


def full_window(agg: Column, c: ColumnOrName, w: WindowSpec, n: int) -> Column:
    """``agg`` over the trailing ``n`` rows, NULL unless all ``n`` rows are present
    and non-NULL (the pandas ``rolling(n)`` default ``min_periods = n``)."""
    frame = trailing(w, n)
    return F.when(F.count(col(c)).over(frame) == n, agg.over(frame))


def rolling_mean(c: ColumnOrName, w: WindowSpec, n: int) -> Column:
    return full_window(F.avg(col(c)), c, w, n)


def rolling_std(c: ColumnOrName, w: WindowSpec, n: int) -> Column:
    """Sample standard deviation (ddof = 1) over a full trailing window."""
    return full_window(F.stddev_samp(col(c)), c, w, n)


def rolling_min(c: ColumnOrName, w: WindowSpec, n: int) -> Column:
    return full_window(F.min(col(c)), c, w, n)


def rolling_max(c: ColumnOrName, w: WindowSpec, n: int) -> Column:
    return full_window(F.max(col(c)), c, w, n)


def pct_change(c: ColumnOrName, w: WindowSpec, periods: int = 1) -> Column:
    """``x / x.shift(periods) - 1``; a zero base gives NULL instead of inf."""
    return safe_div(col(c), F.lag(col(c), periods).over(w)) - F.lit(1.0)


def rsi(delta: ColumnOrName, w: WindowSpec, n: int = 14) -> Column:
    """Simple-mean RSI from a precomputed first-difference column (a window
    function cannot nest inside a window aggregate, so the difference is its own
    pass).  A missing difference (the first row) counts as 0, so the first value
    appears on row ``n``.  Loss 0 with a gain gives 100; a flat window gives NULL."""
    d = F.coalesce(col(delta), F.lit(0.0))
    frame = trailing(w, n)
    full = F.count(F.lit(1)).over(frame) == n
    gain = F.avg(F.when(d > 0, d).otherwise(F.lit(0.0))).over(frame)
    loss = F.avg(F.when(d < 0, -d).otherwise(F.lit(0.0))).over(frame)
    value = (F.when(loss == 0, F.when(gain > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain / loss)))
    return F.when(full, value)


# Sentiment band cut-offs (below 25, below 50, below 75, else).
SENTIMENT_CUTS = (25, 50, 75)


def sentiment_band(v: ColumnOrName) -> Column:
    """Band 0..3 for a 0..100 sentiment value."""
    v = col(v)
    a, b, c = SENTIMENT_CUTS
    return (F.when(v.isNull(), F.lit(None).cast(T.IntegerType()))
            .when(v < a, F.lit(0)).when(v < b, F.lit(1)).when(v < c, F.lit(2)).otherwise(F.lit(3)))


# Trend class names, in label-index (alphabetical) order.
TREND_CLASSES = ("DOWN", "FLAT", "UP")


def trend_label(current: ColumnOrName, future: ColumnOrName, threshold_pct: float = 2.0) -> Column:
    """UP if the change in percent is above +threshold, DOWN if below -threshold,
    else FLAT; NULL when there is no future price.  A zero current price follows
    IEEE semantics (sign of the move decides, no move is FLAT)."""
    cur, fut = col(current), col(future)
    t = F.lit(float(threshold_pct))
    change = ((fut - cur) / cur) * F.lit(100.0)
    by_sign = F.when(fut > 0, F.lit("UP")).when(fut < 0, F.lit("DOWN")).otherwise(F.lit("FLAT"))
    by_change = F.when(change > t, F.lit("UP")).when(change < -t, F.lit("DOWN")).otherwise(F.lit("FLAT"))
    return (F.when(fut.isNull() | cur.isNull(), F.lit(None).cast(T.StringType()))
            .when(cur == 0, by_sign).otherwise(by_change))


ORDER_KEY_TYPE = T.DecimalType(38, 0)
MAX_EVENT_MS = 10**14  # year 5138; times 10^24 it still fits the order key


def event_in_range(event_ms: ColumnOrName) -> Column:
    """Whether a tick time is one in milliseconds that can be ordered and dated."""
    return F.abs(col(event_ms)) < F.lit(MAX_EVENT_MS)


def utc_day(epoch: ColumnOrName, per_second: int = 1) -> Column:
    """The UTC date of an epoch time, whatever the session's time zone."""
    day = F.call_function("div", col(epoch) - F.pmod(col(epoch), F.lit(86400 * per_second)), F.lit(86400 * per_second))
    return F.date_from_unix_date(day.cast("int"))


def order_key(event_ms: ColumnOrName, *seq: tuple[ColumnOrName, int]) -> Column:
    """Pack ``event_ms`` and tie-break numbers into one ``decimal(38,0)``.

    ``order_key(ms, (a, 14), (b, 10))`` orders exactly like ``(ms, a, b)`` as long
    as ``0 <= a < 10**14`` and ``0 <= b < 10**10``.  A decimal ordering keeps
    ``min_by`` / ``max_by`` in Spark's hash aggregate (a struct ordering would
    force a sort-based aggregate over every tick)."""
    total = sum(d for _, d in seq)
    if total > 24:
        raise ValueError("tie-break digits must not exceed 24")
    key = col(event_ms).cast(ORDER_KEY_TYPE) * F.lit(str(10 ** total)).cast(ORDER_KEY_TYPE)
    shift = total
    for c, digits in seq:
        shift -= digits
        key = key + col(c).cast(ORDER_KEY_TYPE) * F.lit(str(10 ** shift)).cast(ORDER_KEY_TYPE)
    return key.cast(ORDER_KEY_TYPE)


def zero_if_missing(c: ColumnOrName) -> Column:
    """NULL or NaN becomes 0.0 (load-time normalisation of volume / cap)."""
    return F.nanvl(F.coalesce(col(c).cast(T.DoubleType()), F.lit(0.0)), F.lit(0.0))


def round_doubles(df, digits: int = 6):
    """Round every double column (used by the comparison catalog only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
