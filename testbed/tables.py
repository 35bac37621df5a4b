"""The library's input tables as SQL over the given tables.

The text runs in Spark and in DuckDB; ``@...@`` marks the few spots where the
dialects differ.  Each table is one SELECT over ``{base}`` tables or over other
tables of this file.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import fixed_values as V
from tidemark.functions.attribution import Rule
from tidemark.functions.predicates import exclusions
from tidemark.operators.dims import DeviceRules
from tidemark.plans.interaction import VIDEO_PAGE_TAGS

# Windows of the runs: there is data on both sides of them.
START, END, TODAY = "2024-01-04", "2024-01-26", "2024-01-27"
# Cumulative runs report from here on and carry the earlier days in.
LATE_START = "2024-01-10"
SHOP_START, SHOP_END = "1996-03-01", "1999-05-28"
HISTORY = "2023-01-01"

RULES = DeviceRules(service_tag="SVC-1", apps=("app.stream", "app.taxi"), taxi_app="app.taxi",
                    vendor_app="app.stream", vendor_word="vendor-x", taxi_category="TAXI")

CAMPAIGN_RULES = [
    Rule(1, "c0", content="//a/", kind="contains"),
    Rule(2, "c1", content="http://b/1"),
    Rule(3, "c2", content="http://b/2"),
    Rule(4, "c2", content="http://b/3"),
    Rule(5, "c3", source="src0", campaign="camp0"),
    Rule(6, "c4", source="src1", campaign="camp0"),
    Rule(7, "c5", source="src1", campaign="camp1"),
    Rule(8, "c9", source="src1"),
]

TAGS = [
    V.CONTENT_BEGIN, V.RECOVER_END, *V.PLAY_TAGS, V.RECOVER_END, V.SCREENSAVER, *V.SCREENSAVER_CLICKS,
    "click_screensaver_dialog", V.TAB_CLICK, V.TAB_AUTO, V.SCREEN_CLOSE, *V.NOT_TOUCH, V.TAB_CLICK,
    "screen_click", "SCREEN_CLICK_SCREEN", *VIDEO_PAGE_TAGS, "video_recommend_click",
    "show_next_screensaver_click", "SCREEN_CLICK_SET_BUTTON", "map_zoomout", "click_business_skip_popular",
    "list_switch", "map_point", "detail_show", "list_load_more", "image_slide", "preview_show", "detail_close",
    "SCREEN_CLICK_SPEAKER_BUTTON", "SCREEN_OTHER_VOLUME_CHANGE", "video_pause_click", "video_start_click",
    "other", None,
]
PAGES = ["2", "40", "38", "5", "video", "page:main, subPage:video", "eat", "3", "page:main, subPage:eat", "28",
         "play", "4", "page:main, subPage:play", "trip", "1", "21", "33", "41", "0", "6", "40", "38", "", None]
TARGETS = [*V.tab_targets("video"), *V.tab_targets("eat"), *V.tab_targets("play"), *V.tab_targets("activity_video"),
           "around", "popular", "video", "", None]


def _pick(index: str, values: list) -> str:
    """One of the values, by index; short to evaluate in both engines."""
    text = "|".join("none" if v is None else v for v in values)
    return f"NULLIF(split_part('{text}', '|', CAST(({index}) % {len(values)} AS INT) + 1), 'none')"


K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
CENTS = "CAST(round({} * 100) AS BIGINT)"

TABLES: dict[str, str] = {
    "screen_event": f"""
SELECT CAST(ts AS DATE) AS p_date, @MILLIS@ AS time_stamp,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'd' || CAST(user_id AS STRING) END AS devicename,
  CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 't' || CAST(user_id AS STRING) || '-'
    || CAST(day(ts) - day(ts) % 2 AS STRING) || '-' || CAST(event_id % 3 AS STRING) END AS traceid,
  CASE k % 23 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'c' || CAST(k % 12 AS STRING) END AS contentid,
  CASE (event_id + k) % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'ad' || CAST(k % 7 AS STRING) END AS adsn,
  {_pick("event_id * 7 + k", TAGS)} AS tag,
  CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'SLIDE' WHEN 'signup' THEN 'ZOOM'
    WHEN 'purchase' THEN 'SCAN' ELSE 'SHOW' END AS event,
  CASE WHEN user_id % 4 = 0 THEN 'TAXI' ELSE 'STREAM' END AS category,
  {_pick("event_id * 5 + k * 3", PAGES)} AS page,
  {_pick("event_id * 11 + k", TARGETS)} AS targetvalue,
  CASE WHEN k % 6 = 0 THEN '' ELSE 'v' || CAST(k % 5 AS STRING) END AS currentvalue,
  CASE WHEN event_id % 2 = 0 THEN '{V.ENDED_NORMALLY}: ok' ELSE 'cut' END AS message,
  CASE WHEN event_id % 50 = 0 THEN 'test' ELSE 'prod' END AS env,
  CASE WHEN k = 99 THEN 'bad' ELSE CAST(150 + k AS STRING) END AS versioncode,
  CASE WHEN k % 11 = 0 THEN NULL ELSE value END AS playtime,
  CASE WHEN k % 8 = 0 THEN '' ELSE 'src' || CAST(k % 5 AS STRING) END AS utmsource,
  'camp' || CAST(event_id % 3 AS STRING) AS utmcampaign,
  CASE WHEN k % 13 = 0 THEN 'http://x//a/' || CAST(k AS STRING) ELSE 'http://b/' || CAST(k % 9 AS STRING) END AS utmcontent
FROM (SELECT *, {K} AS k FROM {{events}}) e""",
    "excluded_device": """
SELECT 'd' || CAST(c_custkey AS STRING) AS devicename FROM {customer} WHERE c_custkey % 25 = 3""",
    "device_service": """
SELECT 'd' || CAST(c_custkey AS STRING) AS third_code, car_id,
  CASE WHEN c_custkey % 13 = 5 THEN 1 ELSE 0 END AS status, CASE WHEN c_custkey % 17 = 6 THEN 1 ELSE 0 END AS is_delete,
  CASE WHEN c_custkey % 19 = 7 THEN 'SVC-2' ELSE 'SVC-1' END AS tag,
  CAST(DATE '2023-12-15' + CAST(c_custkey % 60 AS INT) AS @TS@) AS add_time
FROM (SELECT c_custkey, c_custkey AS car_id FROM {customer}
      UNION ALL SELECT c_custkey, c_custkey + 1 AS car_id FROM {customer} WHERE c_custkey % 29 = 1) c""",
    "screen_info": """
SELECT 'd' || CAST(c_custkey AS STRING) AS device_name,
  CASE WHEN c_custkey % 31 = 8 THEN NULL WHEN c_custkey % 31 = 9 THEN '0' ELSE 'a' || CAST(c_nationkey % 6 AS STRING) END AS owner_sn,
  CASE WHEN c_custkey % 21 = 9 THEN 'app.old' WHEN c_custkey % 3 = 0 THEN 'app.taxi' ELSE 'app.stream' END AS main_app,
  CASE WHEN c_custkey % 23 = 4 THEN NULL WHEN c_custkey % 37 = 2 THEN '测试 device'
    WHEN c_custkey % 5 = 0 THEN 'by vendor-x' ELSE 'ok' END AS desc
FROM {customer}""",
    "screen_car": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 47 = 3 THEN NULL WHEN c_custkey % 43 = 5 THEN 0 WHEN c_nationkey % 5 = 0 THEN 310100
    ELSE 100 + c_nationkey % 5 END AS city_sn,
  CASE WHEN c_custkey % 41 = 6 THEN NULL WHEN c_custkey % 41 = 7 THEN '0' ELSE c_mktsegment END AS car_type
FROM {customer}""",
    "device_snapshot": """
SELECT CAST(ts AS DATE) AS p_date, 'd' || CAST(user_id AS STRING) AS devicename,
  CASE WHEN user_id % 5 = 0 THEN 310100 ELSE 101 END AS city_sn
FROM {events} WHERE user_id % 7 <> 3 GROUP BY CAST(ts AS DATE), user_id""",
    "heartbeat_day": """
SELECT 'd' || CAST(user_id AS STRING) AS sn, CAST(ts AS DATE) AS day FROM {events}
WHERE event_type = 'click' OR event_type = 'view'""",
    "trip_server": "SELECT 'd' || CAST(user_id AS STRING) AS device_name, ts AS add_time FROM {events} WHERE event_type = 'view'",
    "trip_client": "SELECT 'd' || CAST(user_id AS STRING) AS device_name, ts AS add_time FROM {events} WHERE event_type = 'purchase'",
    "sensor_summary": """
SELECT devicename AS sn, p_date AS day, tag FROM {screen_event} WHERE devicename IS NOT NULL
GROUP BY devicename, p_date, tag""",
    "abnormal_device": """
SELECT CASE WHEN event_id % 1499 = 7 THEN NULL ELSE 'd' || CAST(user_id AS STRING) END AS device_name,
  CAST(ts AS DATE) AS day FROM {events} WHERE event_type = 'error' OR event_id % 1499 = 7""",
    "calendar": "SELECT day FROM (SELECT CAST(ts AS DATE) AS day FROM {events}) e GROUP BY day",
    # --- retail ---------------------------------------------------------------
    "driver": """
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 2 THEN 0 ELSE 1 END AS is_checked,
  CASE WHEN s_suppkey % 11 = 3 THEN '' WHEN s_suppkey % 13 = 4 THEN NULL ELSE 'sh' || CAST(s_suppkey AS STRING) END AS shelf_sn,
  CAST(DATE '1994-12-20' + CAST(s_suppkey * 37 % 2400 AS INT) AS @TS@) AS checked_time
FROM {supplier}""",
    "driver_info": """
SELECT s_suppkey AS driver_id, s_nationkey AS distric_sn,
  CASE WHEN s_nationkey % 2 = 0 THEN 'SH' ELSE 'BJ' END || CAST(s_nationkey % 8 AS STRING) AS leasing_company_sn
FROM {supplier}""",
    "city": """
SELECT n_nationkey AS distric_sn, CASE WHEN n_regionkey = 0 THEN 310100 ELSE 200 + n_regionkey END AS city_sn
FROM {nation} WHERE n_nationkey <> 24""",
    "company": """
SELECT sn AS leasing_company_sn, min(r_name) AS city_name, 'co ' || sn AS leasing_company_abbreviation,
  CASE WHEN sn = 'BJ7' THEN 1 WHEN sn = 'BJ5' THEN NULL ELSE 0 END AS is_deleted
FROM (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'SH' ELSE 'BJ' END || CAST(n_nationkey % 8 AS STRING) AS sn, r_name
      FROM {nation} JOIN {region} ON n_regionkey = r_regionkey) n GROUP BY sn""",
    "driver_tag": """
SELECT s_suppkey AS driver_id, CAST(s_suppkey % 3 AS INT) AS work_type,
  CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS stock_warming
FROM {supplier} WHERE s_suppkey % 6 <> 5""",
    "driver_shelf": "SELECT s_suppkey AS driver_id, 'sh' || CAST(s_suppkey AS STRING) AS shelf_sn FROM {supplier}",
    "user_tag": """
SELECT '1' || CAST(c_custkey AS STRING) AS mobile, 'u' || CAST(c_custkey % 4 AS STRING) AS driver_tag
FROM {customer} WHERE c_custkey % 3 <> 0""",
    "shop_order": f"""
SELECT o_orderkey AS id, CAST(o_orderkey AS STRING) AS order_sn,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'cp' || CAST(o_orderkey % 9 AS STRING) END AS coupon_seq,
  o_custkey % (SELECT COUNT(*) + 10 FROM {{supplier}}) AS driver_id, '2' || CAST(o_custkey % (SELECT COUNT(*) + 10 FROM {{supplier}}) AS STRING) AS driver_tel, o_custkey AS user_id,
  '1' || CAST(o_custkey AS STRING) AS user_tel, price, price - pay AS discount_amount, pay AS pay_amount,
  o_orderkey % 4 + 1 AS num, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status,
  CAST(o_orderkey % 3 AS INT) AS pay_type, 'p' || CAST(o_orderkey AS STRING) AS pay_order_sn,
  CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS is_first, o_orderdate AS add_time,
  o_orderdate + INTERVAL 1 DAY AS update_time
FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE {CENTS.format('o_totalprice')} END AS price,
        CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE {CENTS.format('o_totalprice')} - 100 * (o_orderkey % 3) END AS pay
      FROM {{orders}}) o""",
    "order_line": f"""
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_orderkey AS STRING) AS order_sn, l_suppkey AS driver_id,
  '2' || CAST(l_suppkey AS STRING) AS driver_tel, '1' || CAST(l_orderkey % (SELECT COUNT(*) + 200 FROM {{customer}}) AS STRING) AS user_tel,
  'b' || CAST(l_linenumber AS STRING) AS box_sn, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS sku_id,
  {CENTS.format('l_extendedprice')} AS price, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS status,
  l_shipdate AS add_time, l_shipdate + INTERVAL 2 DAY AS update_time
FROM {{lineitem}}""",
    "sku": "SELECT p_partkey AS id, p_name AS name, p_type AS content, p_brand AS img FROM {part} WHERE p_partkey % 9 <> 0",
    "sku_goods": f"""
SELECT p_partkey AS sku_id, {CENTS.format('p_retailprice')} AS goods_purchase_price,
  CAST(p_size % 5 + 1 AS BIGINT) AS goods_num, CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END AS is_deleted FROM {{part}}
UNION ALL
SELECT CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_partkey END AS sku_id, CAST(150 AS BIGINT) AS goods_purchase_price,
  CAST(2 AS BIGINT) AS goods_num, 0 AS is_deleted FROM {{part}} WHERE p_partkey % 4 = 0""",
    "order_comment": """
SELECT CAST(o_orderkey AS STRING) AS order_sn, CAST(o_orderkey % 5 + 1 AS INT) AS appraise,
  CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '1' WHEN 3 THEN '1,2,9' WHEN 4 THEN ' 3, 4 '
    ELSE '5,' END AS tag_id,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'm' || CAST(o_orderkey % 10 AS STRING) END AS comment,
  o_orderdate AS add_time, o_orderdate + INTERVAL 1 DAY AS update_time
FROM {orders}""",
    "comment_tag": "SELECT r_regionkey + 1 AS id, r_name AS tag FROM {region}",
    "scan_line": """
SELECT CASE WHEN event_id % 8 = 0 THEN '[INFO ]' ELSE '' END
  || CASE WHEN event_id % 37 = 5 THEN 'at noon' ELSE CAST(CAST(ts - INTERVAL 9000 DAY AS DATE) AS STRING) END
  || ' 08:30:00,123 [INFO ]web ' || CASE WHEN event_id % 11 = 0 THEN 'otherRequest' ELSE 'submitRequest' END
  || '|' || CASE event_type WHEN 'click' THEN 'home' WHEN 'view' THEN 'home' WHEN 'purchase' THEN 'order' ELSE 'goods' END
  || '|' || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE '1' || CAST(user_id AS STRING) END
  || CASE WHEN event_id % 13 = 0 THEN '' ELSE '|' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE CAST(user_id AS STRING) END
       || '|' || CASE WHEN event_id % 17 = 0 THEN 'null' ELSE 'sh' || CAST(event_id % (SELECT COUNT(*) + 20 FROM {supplier}) AS STRING) END
       || '|' || CASE WHEN event_id % 19 = 0 THEN 'null' WHEN event_id % 23 = 0 THEN 'x1' ELSE CAST(event_id % (SELECT COUNT(*) + 20 FROM {supplier}) AS STRING) END
     END || ' ' AS value
FROM {events}""",
    "replenishment": """
SELECT l_suppkey AS driver_id, CAST(l_orderkey AS STRING) AS rep_sn,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_linenumber % 3 AS INT) END AS rep_type, l_shipdate AS add_time
FROM {lineitem}""",
    "estimate": """
SELECT CAST(l_orderkey AS STRING) AS rep_sn, CAST(l_linenumber % 6 AS INT) AS level, l_shipdate + INTERVAL 1 DAY AS add_time
FROM {lineitem}""",
}
ARCHIVES = {f"trip_archive_{i}": (a, b) for i, (a, b) in enumerate([(1, 7), (8, 14), (15, 21), (22, 31)], start=1)}
for _name, (_a, _b) in ARCHIVES.items():
    TABLES[_name] = ("SELECT 'd' || CAST(user_id AS STRING) AS device_name, ts AS add_time FROM {events} "
                     f"WHERE event_type = 'signup' AND day(ts) BETWEEN {_a} AND {_b}")

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SPARK_DIALECT = {"@MILLIS@": "unix_millis(CAST(ts AS TIMESTAMP))", "@TS@": "TIMESTAMP_NTZ"}
DUCK_DIALECT = {"@MILLIS@": "epoch_us(ts) // 1000", "@TS@": "TIMESTAMP"}


def _dialect(sql: str, tokens: dict[str, str]) -> str:
    for k, v in tokens.items():
        sql = sql.replace(k, v)
    return sql


def _inputs(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Spark DataFrames of the input tables, by attribute name.

    With ``prepared`` they are read from tables that ``prepare`` wrote, laid out
    as in a deployment; else they are derived on the fly.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, prepared: str | None = None):
        self.spark, self.sf_dir, self.prepared = spark, sf_dir, prepared
        self._cache: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            if name in BASE:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in TABLES and self.prepared:
                df = self.spark.read.parquet(f"{self.prepared}/{name}")
            elif name in TABLES:
                sql = _dialect(TABLES[name], SPARK_DIALECT)
                df = self.spark.sql(sql, **{n: getattr(self, n) for n in _inputs(sql)})
            else:
                raise AttributeError(name)
            self._cache[name] = df
        return self._cache[name]

    @property
    def excluded(self):
        """Excluded devices, read once."""
        if "__excluded" not in self._cache:
            self._cache["__excluded"] = exclusions(self.excluded_device)
        return self._cache["__excluded"]

    @property
    def archives(self) -> list[DataFrame]:
        return [getattr(self, n) for n in ARCHIVES]


DAY_COLUMNS = {"screen_event": "p_date", "device_snapshot": "p_date", "heartbeat_day": "day"}


def prepare(spark: SparkSession, sf_dir: str, folder: str) -> Tables:
    """Write all input tables to ``folder``, the big ones partitioned by day."""
    source = Tables(spark, sf_dir)
    for name in TABLES:
        df = getattr(source, name)
        if name in DAY_COLUMNS:
            day = DAY_COLUMNS[name]
            df.repartition(day).write.partitionBy(day).parquet(f"{folder}/{name}")
        elif name in ("shop_order", "order_line", "order_comment", "replenishment", "estimate", "scan_line"):
            df.repartition(8).write.parquet(f"{folder}/{name}")
        else:
            df.coalesce(1).write.parquet(f"{folder}/{name}")
    return Tables(spark, sf_dir, folder)


def duck_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, SQL) of the named tables and what they need, in order."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        if name in out or name in BASE:
            return
        sql = _dialect(TABLES[name], DUCK_DIALECT)
        for n in _inputs(sql):
            add(n)
        out[name] = re.sub(r"\{(\w+)\}", r"\1", sql).strip()

    for n in names:
        add(n)
    return list(out.items())
