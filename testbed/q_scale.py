"""Queries of the device scale and agent reports."""

from __future__ import annotations

from testbed.q_events import ENDED, ENDED_SUMMARY, TRIP_FIGURES, agents, days, trip_figures
from testbed.registry import plain, query
from testbed.tables import END, LATE_START, RULES, START, TODAY
from tidemark.functions import fixed_values as V
from tidemark.operators import dims
from tidemark.operators.presence import union_trips
from tidemark.operators.rollup import roll_up
from tidemark.plans import scale

C2 = ("city_sn", "car_type")
A1 = ("parent_id",)


def bindings(t):
    return dims.city_bindings(t.device_service, t.screen_info, t.screen_car, RULES)


def agent_bindings(t):
    return dims.agent_bindings(t.device_service, t.screen_info, t.screen_car, RULES)


def inputs(t):
    return scale.ScaleInputs(t.heartbeat_day, t.trip_server, t.trip_client, t.archives, t.sensor_summary,
                             t.abnormal_device, t.calendar)


def _k(keys: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(prefix + k for k in keys)


def bound_total(keys) -> str:
    # day by day: how many bindings are there by then?
    return f"""SELECT c.day, {_k(keys, 'so_far.')}, so_far.n AS total_dev_num
FROM (SELECT day FROM calendar INTERSECT SELECT day FROM span WHERE day >= DATE '2019-08-12') c,
LATERAL (SELECT {_k(keys)}, COUNT(*) AS n FROM dim WHERE bind_day <= c.day GROUP BY ALL) so_far"""


def trips_total(keys, dim: str = "dim") -> str:
    return f"""SELECT a.day, {_k(keys, 'g.')}, COUNT(DISTINCT device_name) AS total_trip_dev_num
FROM trip_all JOIN {dim} g ON device_name = third_code JOIN calendar a ON CAST(add_time AS DATE) <= a.day GROUP BY ALL"""


ONE_AGENT = "(SELECT third_code, MIN(parent_id) AS parent_id FROM dim GROUP BY third_code)"


def beats_total(keys) -> str:
    return f"""SELECT s.day, {_k(keys, 'g.')}, COUNT(DISTINCT sn) AS total_heartbeat_dev_num
FROM heartbeat_day h JOIN dim g ON sn = third_code JOIN span s ON GREATEST(h.day, bind_day) <= s.day GROUP BY ALL"""


def normal(keys) -> str:
    # NOT IN, spelled out: no match, and no NULL on the day's list
    return f"""SELECT s.day, {_k(keys, 'b.')}, COUNT(1) AS normal_dev_num FROM span s JOIN dim b ON b.bind_day <= s.day
WHERE NOT EXISTS (SELECT 1 FROM abnormal_device x WHERE x.day = s.day AND (x.device_name = b.third_code OR x.device_name IS NULL))
GROUP BY s.day, {_k(keys, 'b.')}"""


def _same_day(keys, pairs: str, name: str) -> str:
    """Distinct devices of (device, day) pairs per day and group."""
    return f"""SELECT p.day, {_k(keys, 'g.')}, COUNT(DISTINCT p.device) AS {name} FROM ({pairs}) p
JOIN dim g ON p.device = g.third_code WHERE p.day IN (SELECT day FROM span) GROUP BY ALL"""


_LIVE = "SELECT device_name AS device, CAST(add_time AS DATE) AS day FROM {0}"
_BEAT = "SELECT sn AS device, day FROM heartbeat_day"


def trip_devices(keys) -> str:
    return _same_day(keys, _LIVE.format("trip_live"), "daily_trip_dev_num")


def online(keys) -> str:
    return _same_day(keys, f"{_BEAT} INTERSECT {_LIVE.format('trip_live')}", "daily_online_dev_num")


def splash(keys) -> str:
    shown = "SELECT sn AS device, day FROM sensor_summary WHERE tag = 'splash_show_begin'"
    return _same_day(keys, shown, "daily_play_dev_num")


def online_by(keys, table: str, name: str) -> str:
    return _same_day(keys, f"{_BEAT} INTERSECT {_LIVE.format(table)}", name)


def beats(keys) -> str:
    return _same_day(keys, _BEAT, "daily_heartbeat_dev_num")


@query("r12_calendar_extension", f"""
SELECT CAST(unnest(generate_series((SELECT MAX(day) + 1 FROM calendar), DATE '2024-03-10' - 1, INTERVAL 1 DAY)) AS DATE) AS day""")
def _(t):
    return scale.calendar_extension(t.calendar, "2024-03-10")


@query("r13a_bindings_total", bound_total(C2))
def _(t):
    return scale.bindings_total(bindings(t), t.calendar, C2, START, END)


@query("r13a_trip_devices_total", f"SELECT * FROM ({trips_total(C2)}) x WHERE day BETWEEN DATE '{LATE_START}' AND DATE '{END}'")
def _(t):
    total = scale.device_totals(scale.device_firsts(inputs(t), END), bindings(t), C2, LATE_START, END)
    return total.filter("total_trip_dev_num > 0").drop("total_heartbeat_dev_num").join(t.calendar, "day", "left_semi")


@query("r13b_normal_devices", normal(C2))
def _(t):
    return scale.normal_devices(bindings(t), t.abnormal_device, C2, START, END)


SAME_DAY = ("daily_trip_dev_num", "daily_online_dev_num", "daily_play_dev_num", "daily_heartbeat_dev_num",
            "daily_online_dev_num_server", "daily_online_dev_num_client")


def same_day_frames(keys) -> list[str]:
    return [trip_devices(keys), online(keys), splash(keys), beats(keys),
            online_by(keys, "trip_server", SAME_DAY[4]), online_by(keys, "trip_client", SAME_DAY[5])]


@query("r13cdefgi_same_day_devices", f"""
SELECT day, city_sn, car_type, {', '.join(f'CAST(COALESCE(MAX({m}), 0) AS BIGINT) AS {m}' for m in SAME_DAY)}
FROM ({' UNION ALL BY NAME '.join(f'(SELECT * FROM ({q}) y{i})' for i, q in enumerate(same_day_frames(C2)))}) x
GROUP BY day, city_sn, car_type""")
def _(t):
    return scale.daily_presence(scale.day_marks(inputs(t), START, END), bindings(t), C2, START, END)


@query("r13h_heartbeat_total", f"SELECT * FROM ({beats_total(C2)}) x WHERE day >= DATE '{LATE_START}'")
def _(t):
    total = scale.device_totals(scale.device_firsts(inputs(t), END), bindings(t), C2, LATE_START, END)
    return total.filter("total_heartbeat_dev_num > 0").drop("total_trip_dev_num")


SCALE_MEASURES = (
    "total_heartbeat_dev_num", "total_trip_dev_num", "total_play_dev_cnt", "normal_dev_num", "daily_trip_dev_num",
    "daily_online_dev_num", "daily_play_dev_num", "daily_heartbeat_dev_num", "daily_online_dev_num_server",
    "daily_online_dev_num_client", "trip_cnt")
# A group without city or car has only these figures.
OF_ANY_GROUP = ("total_heartbeat_dev_num", "normal_dev_num", "daily_trip_dev_num", "daily_online_dev_num", "daily_play_dev_num")
_FIGURES = {
    "total_heartbeat_dev_num": beats_total(C2), "total_trip_dev_num": trips_total(C2), "normal_dev_num": normal(C2),
    "daily_trip_dev_num": trip_devices(C2), "daily_online_dev_num": online(C2), "daily_play_dev_num": splash(C2),
    "daily_heartbeat_dev_num": beats(C2), "daily_online_dev_num_server": online_by(C2, "trip_server", SAME_DAY[4]),
    "daily_online_dev_num_client": online_by(C2, "trip_client", SAME_DAY[5]),
} | {m: f"SELECT date AS day, city_sn, car_type, {m} FROM ({TRIP_FIGURES}) x" for m in ("total_play_dev_cnt", "trip_cnt")}


def _of_group(measure: str) -> str:
    """The figure of a bound group by its own keys, NULLs included where the group may have it."""
    same = "f.city_sn IS NOT DISTINCT FROM g.city_sn AND f.car_type IS NOT DISTINCT FROM g.car_type"
    if measure not in OF_ANY_GROUP:
        same = "f.city_sn = g.city_sn AND f.car_type = g.car_type"
    return f"COALESCE((SELECT MAX(f.{measure}) FROM ({_FIGURES[measure]}) f WHERE f.day = g.day AND {same}), 0) AS {measure}"


R13_SQL = f"""
SELECT g.day, COALESCE(g.city_sn, 0) AS city_sn, COALESCE(g.car_type, '0') AS car_type, g.total_dev_num,
  {', '.join(map(_of_group, SCALE_MEASURES))},
  COALESCE((SELECT ROUND(t.trip_time_sum / 60, 0) FROM ({TRIP_FIGURES}) t
            WHERE t.date = g.day AND t.city_sn = g.city_sn AND t.car_type = g.car_type), 0) AS trip_time
FROM ({bound_total(C2)}) g"""


@query("r13_device_scale", R13_SQL)
def _(t):
    return plain(scale.device_scale(inputs(t), bindings(t), trip_figures(t), START, END))


# --- agents ---------------------------------------------------------------------------

AGENT_TRIPS = f"""SELECT date AS day, parent_id, CAST(SUM(trip_cnt) AS BIGINT) AS trip_cnt,
  ROUND(COALESCE(SUM(trip_time), 0), 3) AS trip_time_total, CAST(SUM(ad_cnt) AS BIGINT) AS ad_cnt,
  CAST(SUM(show_video_start) AS BIGINT) AS show_video_start, ROUND(COALESCE(SUM(video_time), 0), 3) AS video_time
FROM ({ENDED_SUMMARY}) x JOIN agent_dim d ON x.devicename = d.third_code WHERE parent_id IS NOT NULL GROUP BY 1, 2"""
AGENT_STREAMS = f"""SELECT p_date AS day, parent_id, COUNT(*) FILTER ({ENDED} AND adsn <> '') AS stream_ad_cnt_fulltime,
  ROUND(COALESCE(SUM(playtime) FILTER (tag = 'SCREEN_OTHER_RECOVER_END'), 0), 3) AS video_time_fulltime
FROM ev JOIN agent_dim ON devicename = third_code WHERE parent_id IS NOT NULL GROUP BY ALL"""
AGENT_BASE = f"""SELECT g.day, g.parent_id, g.total_dev_num, (SELECT MAX(f.total_trip_dev_num) FROM ({trips_total(A1, ONE_AGENT)}) f
  WHERE f.day = g.day AND f.parent_id = g.parent_id) AS total_trip_dev_num FROM ({bound_total(A1)}) g"""


@query("r14a_agent_totals", f"SELECT day, parent_id, total_dev_num, COALESCE(total_trip_dev_num, 0) AS total_trip_dev_num FROM ({AGENT_BASE}) x")
def _(t):
    b = agent_bindings(t)
    base = scale.bindings_total(b, t.calendar, A1, START, END)
    trips = scale.device_totals(scale.device_firsts(inputs(t), END), b, A1, START, END, one_group=True)
    return base.join(trips.drop("total_heartbeat_dev_num"), ["day", "parent_id"], "left").fillna(
        0, subset=["total_trip_dev_num"])


@query("r14bcdg_agent_same_day", f"""
SELECT day, parent_id, {', '.join(f'CAST(COALESCE(MAX({m}), 0) AS BIGINT) AS {m}' for m in SAME_DAY)}
FROM ({' UNION ALL BY NAME '.join(f'(SELECT * FROM ({q}) y{i})' for i, q in enumerate(same_day_frames(A1)))}) x
GROUP BY day, parent_id""")
def _(t):
    return scale.daily_presence(scale.day_marks(inputs(t), START, END), agent_bindings(t), A1, START, END)


@query("r14e_agent_trip_summary", AGENT_TRIPS)
def _(t):
    per_device = days(t).filter("trip_cnt > 0").withColumnRenamed("p_date", "day")
    sums = ["trip_cnt", "trip_time", "ad_cnt_ended", "show_video_start", "video_time"]
    rolled = roll_up(per_device, agents(t), ["day", "parent_id"], sums=sums)
    return plain(rolled.withColumnsRenamed({"trip_time": "trip_time_total", "ad_cnt_ended": "ad_cnt"}))


@query("r14f_agent_heartbeat_total", beats_total(A1))
def _(t):
    total = scale.device_totals(scale.device_firsts(inputs(t), END), agent_bindings(t), A1, START, END)
    return total.filter("total_heartbeat_dev_num > 0").drop("total_trip_dev_num")


@query("r14h_agent_streams", AGENT_STREAMS)
def _(t):
    rolled = roll_up(days(t).withColumnRenamed("p_date", "day"), agents(t), ["day", "parent_id"],
                     sums=["stream_ad_ended_fulltime", "video_time_fulltime"])
    return plain(rolled.withColumnRenamed("stream_ad_ended_fulltime", "stream_ad_cnt_fulltime"))


AGENT_COUNTS = ("total_dev_num", "total_trip_dev_num", "daily_trip_dev_num", "daily_online_dev_num",
                "daily_play_dev_num", "trip_cnt", "ad_cnt", "show_video_start", "total_heartbeat_dev_num",
                "daily_heartbeat_dev_num", "stream_ad_cnt_fulltime")
AGENT_COLUMNS = ("day", "parent_id", *AGENT_COUNTS, "trip_time_total", "video_time", "video_time_fulltime")
_AGENT_FRAMES = [AGENT_BASE, trip_devices(A1), online(A1), splash(A1), AGENT_TRIPS, beats_total(A1), beats(A1), AGENT_STREAMS]


@query("r14_agent_day", f"""
SELECT * REPLACE (COALESCE(parent_id, '0') AS parent_id) FROM (
SELECT day, parent_id, {', '.join(f'CAST(COALESCE(MAX({m}), 0) AS BIGINT) AS {m}' for m in AGENT_COUNTS)},
  {', '.join(f'COALESCE(MAX({m}), 0) AS {m}' for m in ('trip_time_total', 'video_time', 'video_time_fulltime'))}
FROM ({' UNION ALL BY NAME '.join(f'(SELECT * FROM ({q}) y{i})' for i, q in enumerate(_AGENT_FRAMES))}) x
GROUP BY day, parent_id) groups""")
def _(t):
    return plain(scale.agent_day(inputs(t), days(t), agent_bindings(t), agents(t), START, END))


@query("u1_trip_tables_union", "SELECT DISTINCT device_name, CAST(add_time AS DATE) AS day FROM trip_all")
def _(t):
    return union_trips([t.trip_server, t.trip_client, *t.archives])


@query("u2_live_trips_union", "SELECT DISTINCT device_name, CAST(add_time AS DATE) AS day FROM trip_live")
def _(t):
    return union_trips([t.trip_server, t.trip_client])
