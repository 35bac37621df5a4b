"""In-car retail: enriched order facts, comments, scan log, company scorecard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions.cells import Day, amount, as_day, day_lit, strip
from tidemark.operators.cumulative import running
from tidemark.operators.frames import align

KEYS = ["day", "company_sn"]
UNMAPPED_TAG = "null"  # fixed value: a comment without a known tag


def on_days(ts: str, start: Day, end: Day) -> Column:
    """Calendar day of a timestamp within the window; Spark turns the cast into
    a range on the raw column, which reaches the scan."""
    return as_day(F.col(ts)).between(day_lit(start), day_lit(end))


def driver_dim(driver_info: DataFrame, city: DataFrame, driver_tag: DataFrame) -> DataFrame:
    """City, company and work type per driver, joined once for both order facts.

    The fact then needs one join on the driver and not three.  A driver known
    from the tag table alone keeps its work type, hence the full join.
    """
    homes = driver_info.join(city.select("distric_sn", "city_sn"), "distric_sn", "left").select(
        F.col("driver_id"), "city_sn", "leasing_company_sn")
    return homes.join(driver_tag.select("driver_id", "work_type"), "driver_id", "full")


def sku_cost(sku_goods: DataFrame) -> DataFrame:
    """Purchase cost per sku: sum of price x number over its live goods."""
    live = sku_goods.filter(F.col("sku_id").isNotNull() & (F.col("is_deleted") == 0))
    return live.groupBy("sku_id").agg(F.sum(F.col("goods_purchase_price") * F.col("goods_num")).alias("cost_price"))


def _enrich(orders: DataFrame, drivers: DataFrame, user_tag: DataFrame) -> DataFrame:
    return orders.join(drivers, "driver_id", "left").join(
        user_tag.select(F.col("mobile").alias("user_tel"), "driver_tag"), "user_tel", "left")


def order_lines(lines: DataFrame, drivers: DataFrame, user_tag: DataFrame, sku: DataFrame, sku_goods: DataFrame,
                start: Day, end: Day) -> DataFrame:
    """Order lines of the window with driver, user, sku and cost attributes."""
    goods = sku.select(F.col("id").alias("sku_id"), "name", "content", "img").join(sku_cost(sku_goods), "sku_id", "full")
    rows = _enrich(lines.filter(on_days("add_time", start, end)), drivers, user_tag).join(goods, "sku_id", "left")
    return rows.select(
        "id", "order_sn", "driver_id", "driver_tel", "city_sn", "leasing_company_sn", "work_type", "user_tel",
        "driver_tag", "box_sn", "sku_id", "name", "content", "img", "price", "cost_price", "status", "add_time",
        "update_time")


def order_cost(line_facts: DataFrame, orders: DataFrame) -> DataFrame:
    """Cost per order over all its lines, whatever their day, for the orders asked for."""
    return line_facts.join(orders.select("order_sn").distinct(), "order_sn", "left_semi").groupBy("order_sn").agg(F.sum("cost_price").alias("cost"))


def order_facts(orders: DataFrame, drivers: DataFrame, user_tag: DataFrame, line_facts: DataFrame, start: Day,
                end: Day) -> DataFrame:
    """Orders of the window with driver and user attributes and their cost.

    ``line_facts`` is the loaded result of ``order_lines`` for all days.
    """
    placed = orders.filter(on_days("add_time", start, end))
    rows = _enrich(placed, drivers, user_tag)
    return rows.join(order_cost(line_facts, placed), "order_sn", "left").select(
        "id", "order_sn", "coupon_seq", "driver_id", "driver_tel", "city_sn",
        F.col("leasing_company_sn").alias("company_sn"), "work_type", "user_id", "user_tel", "driver_tag", "price",
        "discount_amount", "pay_amount", "cost", "num", "status", "pay_type", "pay_order_sn", "is_first", "add_time",
        "update_time")


def order_comments(comments: DataFrame, tags: DataFrame, start: Day, end: Day) -> DataFrame:
    """One row per comment and tag; tag ids are split at commas and not trimmed
    one by one, so ' 2' is unknown.  No tags and unknown tags read 'null'."""
    listed = strip(F.coalesce("tag_id", F.lit("")))
    rows = comments.filter(on_days("add_time", start, end)).select(
        "order_sn", F.col("appraise").cast("int").alias("appraise"), F.coalesce("comment", F.lit("")).alias("comment"),
        "add_time", "update_time", F.explode(F.split(listed, ",")).alias("__id"))
    names = tags.select(F.col("id").cast("string").alias("__id"), "tag")
    return rows.join(names, "__id", "left").select(
        "order_sn", "appraise", F.coalesce("tag", F.lit(UNMAPPED_TAG)).alias("tag"), "comment", "add_time",
        "update_time")


# --- company scorecard -----------------------------------------------------------

@dataclass(frozen=True)
class ScorecardInputs:
    company: DataFrame
    driver: DataFrame
    driver_info: DataFrame
    driver_tag: DataFrame
    driver_shelf: DataFrame
    city: DataFrame
    orders: DataFrame          # raw orders, for the trailing week
    order_facts: DataFrame     # result of order_facts
    scan_log: DataFrame
    replenishment: DataFrame
    estimate: DataFrame


SCORECARD_MEASURES = (
    "online_driver_cnt", "origin_gmv", "gmv", "order_driver_cnt", "order_user_cnt", "order_cnt", "cost", "sku_cnt",
    "gmv_order_driver_cnt", "gmv_order_user_cnt", "gmv_order_cnt", "gmv_order_cost", "gmv_sku_cnt",
    "free_order_driver_cnt", "free_order_user_cnt", "free_order_cnt", "free_order_cost", "free_sku_cnt",
    "scan_drivers_cnt", "scan_uv_cnt", "active_alldriver_cnt", "active_dailydriver_cnt", "weekwork_driver_cnt",
    "replenishment_driver_cnt", "replenishment_order_cnt", "replenishment_comment_cnt", "short_supply_cnt",
)
MONEY = ("origin_gmv", "gmv", "cost", "gmv_order_cost", "free_order_cost")


def order_measures(facts: DataFrame, start: Day, end: Day) -> DataFrame:
    """17 order measures per (day, company) in one aggregation.

    The distinct counts differ by filter, not by column, so they share one
    Expand branch per column (drivers, users) next to the plain sums.
    """
    rows = facts.filter((F.col("status") == 1) & on_days("add_time", start, end)).select(
        as_day(F.col("add_time")).alias("day"), "company_sn", "driver_id", "user_id", "price", "pay_amount", "cost",
        "num", (F.col("price") > 0).alias("paid"), (F.col("price") == 0).alias("free"))

    def total(c, where=None):
        return F.sum(c if where is None else F.when(F.col(where), F.col(c)))

    aggs = [
        amount(total("price")).alias("origin_gmv"),
        amount(total("pay_amount")).alias("gmv"),
    ]
    for prefix, where in (("", None), ("gmv_", "paid"), ("free_", "free")):
        suffix = f" filter (where {where})" if where else ""
        aggs += [
            F.expr(f"count(distinct driver_id){suffix}").alias(f"{prefix}order_driver_cnt"),
            F.expr(f"count(distinct user_id){suffix}").alias(f"{prefix}order_user_cnt"),
            (F.count_if(where) if where else F.count(F.lit(1))).alias(f"{prefix}order_cnt"),
            amount(total("cost", where)).alias(f"{prefix}order_cost" if where else "cost"),
            total("num", where).alias(f"{prefix}sku_cnt"),
        ]
    return rows.groupBy(*KEYS).agg(*aggs)


def online_drivers(driver: DataFrame, driver_info: DataFrame, start: Day, end: Day) -> DataFrame:
    """Checked drivers with a shelf, up to each day."""
    ready = driver.filter((F.col("is_checked") == 1) & (F.col("shelf_sn") != ""))
    daily = (
        ready.join(driver_info.select(F.col("driver_id").alias("id"), "leasing_company_sn"), "id", "left")
        .groupBy(as_day(F.col("checked_time")).alias("day"), F.col("leasing_company_sn").alias("company_sn"))
        .agg(F.count(F.lit(1)).alias("online_driver_cnt"))
    )
    return running(daily, ["company_sn"], ["online_driver_cnt"], start, end)


def activated_drivers(driver: DataFrame, driver_info: DataFrame, start: Day, end: Day) -> DataFrame:
    """Drivers checked up to each day and on the day itself."""
    daily = (
        driver.join(driver_info.select(F.col("driver_id").alias("id"), "leasing_company_sn"), "id", "inner")
        .groupBy(as_day(F.col("checked_time")).alias("day"), F.col("leasing_company_sn").alias("company_sn"))
        .agg(F.count(F.lit(1)).alias("active_alldriver_cnt"))
    )
    total = running(daily, ["company_sn"], ["active_alldriver_cnt"], start, end)
    today = daily.filter(F.col("day").between(day_lit(start), day_lit(end))).withColumnRenamed(
        "active_alldriver_cnt", "active_dailydriver_cnt")
    return align([total, today], KEYS)


def week_drivers(orders: DataFrame, driver_info: DataFrame, start: Day, end: Day) -> DataFrame:
    """Distinct drivers with a paid-for order in the 7 days ending on each day.

    Each driver's order days are made distinct first; a day then counts for
    itself and the six after it.
    """
    paid = orders.filter((F.col("status") == 1) & as_day(F.col("add_time")).between(
        F.date_sub(day_lit(start), 6), day_lit(end)))
    days = paid.select("driver_id", as_day(F.col("add_time")).alias("d")).distinct()
    spread = days.select("driver_id", F.explode(F.sequence(
        F.greatest("d", day_lit(start)), F.least(F.date_add("d", 6), day_lit(end)))).alias("day")).distinct()
    companies = driver_info.select("driver_id", F.col("leasing_company_sn").alias("company_sn")).distinct()
    return spread.join(companies, "driver_id").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("weekwork_driver_cnt"))


def scan_measures(scan_log: DataFrame, driver_shelf: DataFrame, driver_info: DataFrame, start: Day, end: Day) -> DataFrame:
    """Shelves scanned and distinct (shelf, user) pairs on the home module.

    A pair is counted as the text 'shelf-user'; a scan without a user counts
    for its shelf only.
    """
    scans = scan_log.filter((F.col("module") == "home") & on_days("add_time", start, end)).select(
        as_day(F.col("add_time")).alias("day"), "shelf_sn", "user_id").distinct()
    shelves = driver_shelf.join(driver_info, "driver_id").select(
        "shelf_sn", F.col("leasing_company_sn").alias("company_sn")).distinct()
    return scans.join(shelves, "shelf_sn").groupBy(*KEYS).agg(
        F.count_distinct("shelf_sn").alias("scan_drivers_cnt"),
        F.count_distinct(F.concat("shelf_sn", F.lit("-"), F.col("user_id").cast("string"))).alias("scan_uv_cnt"))


def replenishment_measures(replenishment: DataFrame, driver_info: DataFrame, start: Day, end: Day) -> DataFrame:
    """Distinct drivers and replenishment orders (type other than 2)."""
    rows = replenishment.filter((F.col("rep_type") != 2) & on_days("add_time", start, end)).select(
        as_day(F.col("add_time")).alias("day"), "driver_id", "rep_sn").distinct()
    companies = driver_info.select("driver_id", F.col("leasing_company_sn").alias("company_sn")).distinct()
    return rows.join(companies, "driver_id").groupBy(*KEYS).agg(
        F.count_distinct("driver_id").alias("replenishment_driver_cnt"),
        F.count_distinct("rep_sn").alias("replenishment_order_cnt"))


def replenishment_ratings(replenishment: DataFrame, estimate: DataFrame, driver_info: DataFrame, start: Day,
                          end: Day) -> DataFrame:
    """Distinct rated replenishment orders by day of rating.

    Both sides are made distinct before the join, so an order with many lines
    and ratings does not multiply.
    """
    companies = driver_info.select("driver_id", F.col("leasing_company_sn").alias("company_sn")).distinct()
    rated = estimate.filter((F.col("level") > 0) & on_days("add_time", start, end)).select(
        as_day(F.col("add_time")).alias("day"), "rep_sn").distinct()
    # Only the orders rated in the window are looked for in the whole history.
    asked = replenishment.filter(F.col("rep_type") != 2).join(rated.select("rep_sn").distinct(), "rep_sn", "left_semi")
    owned = asked.select("driver_id", "rep_sn").distinct().join(companies, "driver_id").select("rep_sn", "company_sn").distinct()
    return rated.join(owned, "rep_sn").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("replenishment_comment_cnt"))


def short_supply(driver_info: DataFrame, driver_tag: DataFrame, city: DataFrame, special_city: int = V.SPECIAL_CITY,
                 company_text: str = "SH") -> DataFrame:
    """Drivers of one city with a stock warning, by company; the same every day."""
    districts = city.filter(F.col("city_sn") == special_city).select("distric_sn")
    local = driver_info.join(districts, "distric_sn", "left_semi").select("driver_id")
    warned = driver_tag.filter(F.col("stock_warming") == 1).join(local, "driver_id", "left_semi")
    companies = driver_info.filter(F.col("leasing_company_sn").contains(company_text))
    return companies.join(warned.select("driver_id"), "driver_id").groupBy(
        F.col("leasing_company_sn").alias("company_sn")).agg(F.count(F.lit(1)).alias("short_supply_cnt"))


def scorecard(t: ScorecardInputs, start: Day, end: Day) -> DataFrame:
    """27 measures per (day, company) for companies with online drivers.

    The rows are those of the online-driver figure, so neither a company
    without online drivers nor a company missing from the company table shows
    up.  All dated measures are folded by one aggregation and joined once.
    """
    live = t.company.filter(F.col("is_deleted") != 1).select(
        F.col("leasing_company_sn").alias("company_sn"), F.col("leasing_company_abbreviation").alias("company"),
        F.col("city_name").alias("city"))
    base = online_drivers(t.driver, t.driver_info, start, end).filter("online_driver_cnt > 0").join(live, "company_sn")
    dated = align([
        order_measures(t.order_facts, start, end),
        scan_measures(t.scan_log, t.driver_shelf, t.driver_info, start, end),
        activated_drivers(t.driver, t.driver_info, start, end),
        week_drivers(t.orders, t.driver_info, start, end),
        replenishment_measures(t.replenishment, t.driver_info, start, end),
        replenishment_ratings(t.replenishment, t.estimate, t.driver_info, start, end),
    ], KEYS)
    joined = base.join(dated, KEYS, "left").join(short_supply(t.driver_info, t.driver_tag, t.city), "company_sn", "left")
    return joined.select("day", "company_sn", "company", "city", *[
        F.coalesce(m, F.lit(0).cast("decimal(20,2)" if m in MONEY else "bigint")).alias(m) for m in SCORECARD_MEASURES])
