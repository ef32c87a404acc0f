"""The warehouse's analytical queries and event-history paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom import schemas as S


def daily_delta(fact: DataFrame) -> DataFrame:
    """Query 1: stock change per product per day (one partial + final hash aggregate)."""
    return fact.groupBy("product_id", "date_id").agg(F.sum("quantity").alias("daily_delta"))


def event_type_breakdown(fact: DataFrame) -> DataFrame:
    """Query 2: events and total impact per type (ordered by count desc at presentation)."""
    return fact.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("quantity").alias("total_quantity")
    )


def running_balance(fact: DataFrame) -> DataFrame:
    """Query 3: running stock per product with the default RANGE frame.

    Rows of the same day share one value (peers of the ORDER BY key), so the balance only
    depends on daily totals: aggregate to one row per (product, day) first (partial
    aggregation map side), run the window over those (a product's window is bounded by its
    number of days, however many events it has), then attach the value to each event row
    with an equi-join on (product, day), which AQE can split if one day is hot.
    """
    daily = fact.groupBy("product_id", "date_id").agg(F.sum("quantity").alias("_day"))
    w = Window.partitionBy("product_id").orderBy("date_id")
    cum = daily.select("product_id", "date_id", F.sum("_day").over(w).alias("running_balance"))
    return fact.select("product_id", "date_id", "quantity").join(cum, ["product_id", "date_id"], "inner").select(
        "product_id", "date_id", "quantity", "running_balance"
    )


def _event_order(desc: bool) -> list:
    cols = [F.col("created_at"), F.col("id")]
    return [c.desc() for c in cols] if desc else [c.asc() for c in cols]


def event_page(
    log: DataFrame,
    product_id: int,
    org: int,
    limit: int = S.PAGE_DEFAULT,
    offset: int = 0,
    event_type: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """L1/L2/P5: one page of one product's history, ``(created_at, id)`` order.

    The filter on org/product/type reaches the Parquet scan; Spark plans ``offset+limit``
    as a TakeOrderedAndProject (per-partition top-k, no full sort).
    """
    if not 1 <= limit <= S.PAGE_MAX:
        raise ValueError(f"limit must be within 1..{S.PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    f = log.filter((F.col("organization_id") == org) & (F.col("product_id") == product_id))
    if event_type is not None:
        f = f.filter(F.col("event_type") == event_type)
    return f.orderBy(*_event_order(descending)).offset(offset).limit(limit)


def day_index(log: DataFrame) -> DataFrame:
    """Events per product and day: what ``deep_page`` needs to find the days of a page. Kept next to the
    log, it grows with product-days, not with events, and new days only add to it."""
    return log.groupBy("organization_id", "product_id", F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("events"))


def page_days(index: DataFrame, product_id: int, org: int, limit: int, offset: int, descending: bool = False) -> tuple | None:
    """(first day, last day, rows of those days before the page) of one page, or None behind the end.
    A running sum over the days of one product; the driver gets one row."""
    days = index.filter((F.col("organization_id") == org) & (F.col("product_id") == product_id))
    order = F.col("day").desc() if descending else F.col("day").asc()
    until = F.sum("events").over(Window.partitionBy("organization_id", "product_id").orderBy(order))
    spans = days.select("day", (until - F.col("events")).alias("start"), until.alias("until"))
    on_page = spans.filter((F.col("until") > offset) & (F.col("start") < offset + limit))
    first, last, start = on_page.agg(F.min("day"), F.max("day"), F.min("start")).first()
    return None if first is None else (first, last, offset - start)


def deep_page(log: DataFrame, index: DataFrame, product_id: int, org: int, limit: int = S.PAGE_DEFAULT, offset: int = 0, descending: bool = False) -> DataFrame:
    """L1 at any depth: the page that ``event_page`` gives, from the rows of its own days only. The day
    range is a filter on ``created_at`` and, if ``log`` is the partitioned lake, on its day folders, so
    the days before the page are not opened, however many rows they have."""
    if not 1 <= limit <= S.PAGE_MAX:
        raise ValueError(f"limit must be within 1..{S.PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    found = page_days(index, product_id, org, limit, offset, descending)
    if found is None:
        return log.limit(0)
    first, last, skip = found
    rows = log.filter((F.col("organization_id") == org) & (F.col("product_id") == product_id))
    rows = rows.filter((F.col("created_at") >= F.lit(first)) & (F.col("created_at") < F.date_add(F.lit(last), 1)))
    if {"org_id", "year", "month", "day"} <= set(log.columns):
        folder = F.concat_ws("-", "year", "month", "day")
        rows = rows.filter((F.col("org_id") == org) & folder.between(str(first), str(last)))
    return rows.orderBy(*_event_order(descending)).offset(skip).limit(limit)


def event_count(log: DataFrame, page_size: int = S.DASHBOARD_PAGE) -> DataFrame:
    """Events per product and number of pages ``max(1, ceil(n / size))``."""
    return log.groupBy("organization_id", "product_id").agg(
        F.count(F.lit(1)).alias("event_count")
    ).withColumn(
        "pages", F.greatest(F.lit(1), F.ceil(F.col("event_count") / F.lit(page_size))).cast("int")
    )


def event_pages_per_product(log: DataFrame, page: int, page_size: int = S.DASHBOARD_PAGE, descending: bool = True) -> DataFrame:
    """L3: page ``page`` (1-based) of every product at once: ``row_number`` per product."""
    w = Window.partitionBy("organization_id", "product_id").orderBy(*_event_order(descending))
    lo, hi = (page - 1) * page_size + 1, page * page_size
    return log.withColumn("position", F.row_number().over(w)).filter(
        F.col("position").between(lo, hi)
    )


def display_rows(log: DataFrame, products: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``name (sku)`` label and minute-resolution timestamp text for history rows."""
    p = products.select("product_id", "organization_id", "name", "sku")
    return log.join(p, ["product_id", "organization_id"], "inner").select(
        "id",
        "event_id",
        "product_id",
        "event_type",
        "quantity",
        F.concat(F.col("name"), F.lit(" ("), F.col("sku"), F.lit(")")).alias("product_label"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created_text"),
        *keep,
    )
