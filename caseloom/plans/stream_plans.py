"""Streaming operators run over whole tables; the same plans take a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.plans.base import register
from caseloom.session import table
from caseloom.streaming import ingest


@register("events_windowed_counts", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_windowed_counts(spark, d):
    rows = ingest.windowed_counts(table(spark, d, "events"), "ts", "event_type")
    return rows.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))
