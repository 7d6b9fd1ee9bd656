"""Progress counters, metric points, dashboards and log queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultlens.constants import (ERROR_NOISE, ERROR_SPELLINGS, METRIC_BYTES_NAMES, METRIC_COUNT_NAMES,
                                 METRIC_UNIT, METRIC_WINDOW, SECONDS_PER_DAY, STAGE_FIELDS)
from vaultlens.operators.scan import suffix_min
from vaultlens.sources.batches import write_batch

COUNTERS = [name for _, name in STAGE_FIELDS] + ["total", "throttledBytes", "failedBytes", "errorCount"]


def drop_removals(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("event_name") != "REMOVE")


def _reached(f: str) -> Column:
    old_f = F.when(F.col("old").isNotNull(), F.col("old").getField(f))
    return old_f.isNull() & F.col("new").getField(f).isNotNull()


def stage_counts(changes: DataFrame, group_cols: list | None = None) -> DataFrame:
    """Records in which each stage field went from absent to present, and their bytes.

    Wide: ``<counter>_count`` and ``<counter>_bytes`` per stage. Partial sums,
    so it scales with any batch size.
    """
    c = drop_removals(changes)
    aggs = []
    for f, name in STAGE_FIELDS:
        aggs.append(F.coalesce(F.sum(F.when(_reached(f), 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"{name}_count"))
        aggs.append(F.coalesce(F.sum(F.when(_reached(f), F.col("new").getField("sz")).otherwise(0)), F.lit(0))
                    .cast("bigint").alias(f"{name}_bytes"))
    return c.groupBy(*(group_cols or [])).agg(*aggs)


def stage_rows(wide: DataFrame, keep: list | None = None) -> DataFrame:
    """Wide stage counters -> one row per stage (``stage, n, bytes``)."""
    entries = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(f"{name}_count").alias("n"),
                                 F.col(f"{name}_bytes").alias("bytes")) for _, name in STAGE_FIELDS])
    return wide.select(*(keep or []), F.inline(entries))


def counter_deltas(wide: DataFrame) -> DataFrame:
    """Counter increments (pk, counter, value): ``count`` and ``volume`` items."""
    rows = stage_rows(wide)
    cnt = rows.select(F.lit("count").alias("pk"), F.col("stage").alias("counter"), F.col("n").alias("value"))
    vol = rows.select(F.lit("volume").alias("pk"), F.col("stage").alias("counter"), F.col("bytes").alias("value"))
    return cnt.unionByName(vol)


def throttle_deltas(throttle: DataFrame, drain: bool = False) -> DataFrame:
    """Throttled bytes and errors as counter increments; ``drain``: as the decrements that follow
    once a wait has taken them up."""
    sign = -1 if drain else 1
    t = throttle.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("throttled_bytes", "errors")])
    item = lambda counter, c: F.struct(F.lit("throttling").alias("pk"), F.lit(counter).alias("counter"),
                                       (sign * F.col(c)).alias("value"))
    return t.select(F.inline(F.array(item("throttledBytes", "throttled_bytes"), item("errorCount", "errors"))))


def counter_totals(deltas: DataFrame) -> DataFrame:
    """Atomic-add semantics: sum of all deltas per (pk, counter); missing means 0."""
    return deltas.groupBy("pk", "counter").agg(F.sum("value").cast("bigint").alias("value"))


def counter_get(counters: DataFrame, pk: str) -> DataFrame:
    """One counter item as a single wide row with all known counters (no row when the item is
    missing). The counters are listed, so no job runs to find them."""
    return counters.where(F.col("pk") == pk).groupBy("pk").pivot("counter", COUNTERS).agg(F.first("value"))


def progress_points(counters: DataFrame) -> DataFrame:
    """Metric points (metric, value) from the counter table.

    The eight progress metrics are always present (0 when missing); each is
    capped at its own total when that total exists. Totals, throttling and
    failure metrics appear only when their item exists.
    """
    def val(pk, counter):
        return F.max(F.when((F.col("pk") == pk) & (F.col("counter") == counter), F.col("value")))

    wide = counters.agg(
        *[val("count", c).alias(f"c_{c}") for c, _ in METRIC_COUNT_NAMES],
        *[val("volume", c).alias(f"v_{c}") for c, _ in METRIC_BYTES_NAMES],
        val("count", "total").alias("c_total"), val("volume", "total").alias("v_total"),
        val("throttling", "throttledBytes").alias("t_bytes"), val("throttling", "errorCount").alias("t_errors"),
        val("archives-failed", "failedBytes").alias("f_bytes"), val("archives-failed", "errorCount").alias("f_errors"))

    def capped(col, total):
        x = F.coalesce(F.col(col), F.lit(0))
        return F.when(F.col(total).isNotNull(), F.least(x, F.col(total))).otherwise(x)

    items = [F.struct(F.lit(m).alias("metric"), capped(f"c_{c}", "c_total").alias("value"), F.lit(True).alias("keep"))
             for c, m in METRIC_COUNT_NAMES]
    items += [F.struct(F.lit(m).alias("metric"), capped(f"v_{c}", "v_total").alias("value"), F.lit(True).alias("keep"))
              for c, m in METRIC_BYTES_NAMES]
    # --- fixed values: optional metric names
    for m, col, gate in [("ArchiveCountTotal", "c_total", "c_total"), ("BytesTotal", "v_total", "c_total"),
                         ("ThrottledBytes", "t_bytes", "t_errors"), ("ThrottledErrorCount", "t_errors", "t_errors"),
                         ("FailedArchivesBytes", "f_bytes", "f_errors"),
                         ("FailedArchivesErrorCount", "f_errors", "f_errors")]:
        items.append(F.struct(F.lit(m).alias("metric"), F.col(col).alias("value"),
                              F.col(gate).isNotNull().alias("keep")))
    return (wide.select(F.inline(F.array(*items)))
                .where("keep").select("metric", F.col("value").cast("bigint").alias("value")))


def metric_timeline(points: DataFrame, window: str = METRIC_WINDOW) -> DataFrame:
    """Maximum of each metric per tumbling window."""
    return (points.groupBy(F.window("ts", window).alias("w"), "metric")
                  .agg(F.max("value").alias("max_value"))
                  .select(F.col("w.start").alias("window_start"), "metric", "max_value"))


def latest_metric_values(points: DataFrame, seq=None) -> DataFrame:
    """Current (latest) value of each metric."""
    order = seq if seq is not None else F.col("ts")
    return points.groupBy("metric").agg(F.max_by("value", order).alias("value"))


def oldest_message_age(messages: DataFrame, period_s: int = 300, report_us: Column | None = None) -> DataFrame:
    """Age of the oldest undelivered message per queue, sampled at every period end.

    A message is in flight from ``sent_us`` until ``done_us``, and without one until the
    report time (default: the latest time in the table). Messages are first reduced to the
    oldest per (queue, last period): at most one row a period. A running minimum from the
    last period down then gives each stretch of periods its oldest message, and only these
    stretches, which do not overlap, become rows. The minimum is scanned in blocks of a day's
    periods, so a queue with all messages is spread over its days.
    """
    p = period_s * 1_000_000
    if report_us is None:
        report_us = messages.agg(F.max(F.greatest("sent_us", F.coalesce("done_us", "sent_us")))).scalar()
    period = lambda t: F.ceil(t / F.lit(float(p))).cast("bigint")
    m = messages.select("queue", "sent_us", (period(F.coalesce("done_us", report_us)) - 1).alias("last")) \
                .where(period(F.col("sent_us")) <= F.col("last"))
    g = m.groupBy("queue", "last").agg(F.min("sent_us").alias("sent_us"))
    g = suffix_min(g, "queue", "last", "sent_us", "oldest_us", max(1, SECONDS_PER_DAY // period_s))
    first = F.greatest(period(F.col("oldest_us")), F.coalesce(F.col("last_below") + 1, period(F.col("oldest_us"))))
    ex = g.withColumn("first", first).where("first <= last") \
          .select("queue", "oldest_us", F.explode(F.sequence("first", "last")).alias("k"))
    return ex.select("queue", (F.col("k") * p).alias("at_us"), (F.col("k") * p - F.col("oldest_us")).alias("age_us"))


def error_log(logs: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Lines containing one of the three spellings of 'error' and none of the
    known noise messages, newest first.

    ``tiebreak`` (e.g. a unique event id) joins the sort key, so the range
    partitioning of the sort can split a timestamp shared by many lines.
    """
    hit = reduce(lambda a, b: a | b, [F.col("message").contains(s) for s in ERROR_SPELLINGS])
    noise = reduce(lambda a, b: a | b, [F.col("message").contains(s) for s in ERROR_NOISE])
    keys = [F.col("ts").desc()] + [F.col(c).desc() for c in (tiebreak or [])]
    return logs.where(hit & ~noise).orderBy(*keys)


def metric_point_rows(points: DataFrame, dimension: str, ts=None) -> DataFrame:
    """(metric, value) -> published rows ``ts, metric, dimension, unit, value``."""
    when = F.current_timestamp() if ts is None else (F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts)
    return points.select(when.alias("ts"), "metric", F.lit(dimension).alias("dimension"),
                         F.lit(METRIC_UNIT).alias("unit"), F.col("value").cast("bigint").alias("value"))


def write_metric_points(points: DataFrame, path: str, dimension: str, batch_id: int, ts=None) -> None:
    """Add one batch of points to the metric table. Publishing a batch again replaces it; a reader
    finds the old one until the new one is whole (:mod:`vaultlens.sources.batches`)."""
    write_batch(metric_point_rows(points, dimension, ts), path, batch_id)
