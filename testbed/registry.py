"""Registry of queries: a Spark function and, where SQL can say it, its oracle."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from testbed.tables import END, START, TABLES, Tables, duck_ctes
from tidemark.session import shared_dir


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

# Views for the oracles only, from the definitions of the survey: what is a binding, what is a screen in service, and
# which of both belong together.
VIEWS: dict[str, str] = {
    "binding": """SELECT third_code, car_id, CAST(add_time AS DATE) AS bind_day FROM device_service
WHERE tag = 'SVC-1' AND status + is_delete = 0""",
    "in_service": """SELECT device_name, owner_sn, main_app = 'app.taxi' AS taxi, regexp_matches(i.desc, 'vendor-x') AS of_vendor_x
FROM screen_info i WHERE regexp_full_match(main_app, 'app[.](stream|taxi)') AND position('测试' IN i.desc) = 0""",
    "dim": """SELECT v.third_code, c.city_sn, c.car_type, v.bind_day, s.owner_sn AS parent_id
FROM binding v, in_service s, screen_car c WHERE s.device_name = v.third_code AND c.id = v.car_id""",
    "taxi_dim": """SELECT * FROM dim WHERE EXISTS (FROM in_service s WHERE s.taxi AND s.device_name = third_code)""",
    "agent_dim": """SELECT v.third_code, s.owner_sn AS parent_id FROM binding v, in_service s WHERE s.device_name = v.third_code""",
    "vendor_dim": """SELECT v.third_code, if(s.of_vendor_x, 'vendor-x', 'ELSE') AS type
FROM binding v, in_service s WHERE s.device_name = v.third_code AND NOT s.taxi""",
    "trip_all": " UNION ".join(
        f"SELECT device_name, add_time FROM {n}" for n in
        ["trip_server", "trip_client", "trip_archive_1", "trip_archive_2", "trip_archive_3", "trip_archive_4"]),
    "trip_live": "SELECT device_name, add_time FROM trip_server UNION SELECT device_name, add_time FROM trip_client",
    "span": f"SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS day",
    # production rows up to the last day, without test devices, and those of the window
    "ev_hist": f"""SELECT * FROM screen_event e WHERE env = 'prod' AND p_date <= DATE '{END}' AND devicename IS NOT NULL
AND NOT EXISTS (FROM excluded_device x WHERE x.devicename = e.devicename)""",
    "ev": f"SELECT * FROM ev_hist WHERE p_date >= DATE '{START}'",
}


def with_ctes(sql: str) -> str:
    """The query with the tables and views it names in front."""
    def names(text: str) -> set[str]:
        return set(re.findall(r"\b\w+\b", text))

    views, seen = [], names(sql)
    pending = [v for v in VIEWS if v in seen]
    while pending:
        v = pending.pop()
        if v in views:
            continue
        views.append(v)
        more = names(VIEWS[v])
        seen |= more
        pending += [w for w in VIEWS if w in more and w != v]
    ctes = duck_ctes([t for t in TABLES if t in seen])
    # views use only views that stand before them
    ordered = [v for v in VIEWS if v in views]
    parts = [f"{n} AS MATERIALIZED ({q})" for n, q in ctes] + [f"{v} AS ({VIEWS[v]})" for v in ordered]
    if not parts:
        return sql
    return (f"WITH {', '.join(parts)} {sql}" if not sql.lstrip().upper().startswith("WITH ")
            else f"WITH {', '.join(parts)}, {sql.lstrip()[5:]}")


def query(name: str, sql: str | None = None):
    """Register ``build``; the SQL may use any input table or view by name."""
    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, None if sql is None else with_ctes(sql))
        return build
    return add


def scratch_dir(spark) -> str:
    """A new folder for the tables of a query or a bench: in the cluster's shared folder, on one machine in /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        root = shared_dir(spark)
    return f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}" if root else tempfile.mkdtemp(prefix="run-", dir="/tmp")


def plain(df: DataFrame, digits: int = 3) -> DataFrame:
    """Doubles rounded and decimals as doubles: sums of doubles differ between
    engines in their last bits."""
    cols = []
    for f in df.schema:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "double":
            c = F.round(c, digits)
        elif kind == "decimal":
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
