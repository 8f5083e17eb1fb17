"""Grouped and windowed statistics.

All of these are partial-then-final hash aggregations: each task reduces its rows to one
per group before the single shuffle, so a key with a third of all rows costs no more there
than any other.
"""

import math

from pyspark.sql import functions as F

from tidegauge import schemas

BY = ["resid", "date"]


def _extremes(metrics):
    named = [("max", F.max), ("min", F.min), ("avg", F.avg)]
    return [f(m).alias(prefix + m) for m in metrics for prefix, f in named]


def sensor_stats(df, metrics=None, by=BY):
    """Maximum, minimum and average of each metric: maxhz, minhz, avghz, and so on."""
    return df.groupBy(*by).agg(*_extremes(metrics or schemas.METRICS))


def sensor_counts(df, by=BY):
    """Rows with a resid, as ``total``."""
    return df.groupBy(*by).agg(F.count("resid").alias("total"))


def event_time():
    """Date and time of a sensor row as a timestamp without zone."""
    return F.to_timestamp_ntz(F.concat_ws(" ", "date", "time"))


# The units of a length of time, in milliseconds.
_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
          "day": 86_400_000, "week": 604_800_000}


def milliseconds(text):
    """A length of time such as ``'6 seconds'``."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.lower().rstrip("s")]


def pane_length(length, slide):
    """The longest time that both the length and the slide of a window are multiples of."""
    return f"{math.gcd(milliseconds(length), milliseconds(slide))} milliseconds"


def _timed(df, time, ts, watermark):
    """``df`` with the time of each row as ``_at``."""
    if time == "processing":
        at = F.current_timestamp()
    elif time == "event":
        at = F.col(ts) if ts else event_time()
    else:
        raise ValueError(f"unknown time {time!r}")
    if watermark is not None:  # asks for a timestamp with zone
        at = at.cast("timestamp")
    df = df.withColumn("_at", at)
    return df if watermark is None else df.withWatermark("_at", watermark)


def panes(df, metrics=("psi",), length="6 seconds", slide="2 seconds", time="event", ts=None,
          watermark=None):
    """Sums of the rows of each pane and group, from which ``windows_of_panes`` makes windows.

    Panes do not overlap and every window consists of some, so each row is in one pane and is
    aggregated once, however many windows it is in. Columns: p_start, resid, date, rows, and of
    each metric its count, sum, maximum and minimum.
    """
    timed = _timed(df, time, ts, watermark)
    found = timed.groupBy(F.window("_at", pane_length(length, slide)).alias("_p"), *BY).agg(
        F.count("resid").alias("rows"),
        *[f(m).alias(prefix + m) for m in metrics for prefix, f in
          (("count", F.count), ("sum", F.sum), ("max", F.max), ("min", F.min))])
    return found.select(F.col("_p.start").alias("p_start"), *[c for c in found.columns if c != "_p"])


def windows_of_panes(found, metrics=("psi",), length="6 seconds", slide="2 seconds", total=True):
    """Sliding windows ``[w_start, w_start + length)`` from the sums of their panes."""
    grouped = found.groupBy(F.window("p_start", length, slide).alias("_w"), *BY)
    rows = [F.sum("rows").alias("total")] if total else []
    return grouped.agg(*rows, *[c for m in metrics for c in (
        F.max(f"max{m}").alias(f"max{m}"), F.min(f"min{m}").alias(f"min{m}"),
        F.try_divide(F.sum(f"sum{m}"), F.sum(f"count{m}")).alias(f"avg{m}"))]).select(
        F.col("_w.start").alias("w_start"), *BY, *(["total"] if total else []),
        *[p + m for m in metrics for p in ("max", "min", "avg")])


def _windowed(df, metrics, length, slide, time, ts, watermark, total):
    if not df.isStreaming:
        found = panes(df, metrics, length, slide, time, ts)
        return windows_of_panes(found, metrics, length, slide, total)
    # One stateful step, as a stream in update mode takes no second aggregation.
    grouped = _timed(df, time, ts, watermark).groupBy(
        F.window("_at", length, slide).alias("w"), *BY)
    rows = [F.count("resid").alias("total")] if total else []
    found = grouped.agg(*rows, *_extremes(metrics))
    return found.select(F.col("w.start").alias("w_start"), *[c for c in found.columns if c != "w"])


def windowed_counts(df, length="6 seconds", slide="2 seconds", time="event", ts=None,
                    watermark=None):
    """``sensor_counts`` in each sliding window ``[start, start + length)``.

    Windows start at multiples of ``slide`` since 1970. The event time is column ``ts``, by
    default date and time of the row; ``time='processing'`` goes by the clock of the batch.
    A stream in append mode needs a ``watermark``.
    """
    return _windowed(df, (), length, slide, time, ts, watermark, True)


def windowed_stats(df, metrics=("psi",), length="6 seconds", slide="2 seconds", time="event",
                   ts=None, watermark=None):
    """``sensor_stats`` in each sliding window."""
    return _windowed(df, metrics, length, slide, time, ts, watermark, False)


def windowed_report(df, metrics=("psi",), length="6 seconds", slide="2 seconds",
                    time="event", ts=None, watermark=None):
    """Counts and statistics of each sliding window in one aggregation."""
    return _windowed(df, metrics, length, slide, time, ts, watermark, True)
