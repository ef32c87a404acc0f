"""Daily demand features per product (A4, W2) and the per-org feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom import schemas as S


def daily_features(fact: DataFrame, org: int | None = None, window_rows: int = 7) -> DataFrame:
    """A4 + W2: per (org, product, day) sold / purchased / net units and the mean of
    ``units_sold`` over the last ``window_rows`` *rows* (days without events have no row).

    One aggregation (partial + final) and one window, both keyed by product, so the window
    reuses the aggregation's hash partitioning (no second shuffle).
    """
    f = fact if org is None else fact.filter(F.col("organization_id") == org)
    et, q = F.col("event_type"), F.col("quantity")
    daily = f.groupBy("organization_id", "product_id", F.col("date_id").alias("date")).agg(
        F.sum(F.when(et.isin(*S.OUTFLOW_TYPES), F.abs(q)).otherwise(0)).cast("long").alias("units_sold"),
        F.sum(F.when(et.isin(*S.INFLOW_TYPES), q).otherwise(0)).cast("long").alias("units_purchased"),
        F.sum(q).cast("long").alias("net_delta"),
    )
    w = Window.partitionBy("organization_id", "product_id").orderBy("date").rowsBetween(-(window_rows - 1), 0)
    return daily.withColumn("rolling_avg_7d", F.avg("units_sold").over(w))
