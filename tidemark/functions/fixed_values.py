"""Fixed values of the report definitions (tag names, page codes, defaults).

Deployment-specific values (application ids, service tag, campaign rules, test
devices) are not here: they are arguments or input tables.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values: event tags -------------------------------------------------
CONTENT_BEGIN = "SCREEN_OTHER_CONTENT_BEGIN"
RECOVER_END = "SCREEN_OTHER_RECOVER_END"
SPLASH = "splash_show_begin"
SCREENSAVER = "screensaver_ad_begin"
TAB_CLICK = "screen_tab_click"
TAB_AUTO = "tab_auto_switch"
SCREEN_CLOSE = "screen_close"
ENDED_NORMALLY = "内容正常结束"  # message prefix of a play that ran to its end

PLAY_TAGS = (CONTENT_BEGIN, SPLASH, "video_banner_click", "click_video_detail", "video_banner_show")
SCREENSAVER_CLICKS = ("click_show_screensaver_detail", "click_invalid_screensaver_detail")
FULLTIME_TAGS = PLAY_TAGS + (SCREENSAVER,) + SCREENSAVER_CLICKS
ADPLAN_TAGS = FULLTIME_TAGS + ("click_screensaver_dialog",)
HISTORY_TAGS = (CONTENT_BEGIN, SPLASH, "video_banner_click", "click_video_detail")

# --- fixed values: events that count as interaction, and tags that do not -----
TOUCH_EVENTS = ("CLICK", "SLIDE", "ZOOM")
CLICK_EVENTS = ("CLICK", "SLIDE")
PLAYER_TAGS = (
    "video_start", "video_pause", "video_resume",
    "SCREEN_CLICK_STOP_PLAY", "SCREEN_CLICK_RECOVER_PLAY", "SCREEN_CLICK_CONSOLE_AUTO_VANISH",
)
SWITCH_TAGS = ("sub_tab_auto_change", "list_auto_swith_time")
RECOMMEND_SWITCH = "video_recommend_swith"
NOT_TOUCH = PLAYER_TAGS + SWITCH_TAGS
NOT_TOUCH_VIDEO = NOT_TOUCH + (RECOMMEND_SWITCH,)
NOT_EFFECT = NOT_TOUCH + ("screen_click",)
NOT_EFFECT_VIDEO = NOT_TOUCH_VIDEO + ("screen_click", "SCREEN_CLICK_SCREEN")
NOT_CONTENT_TOUCH = tuple(t for t in NOT_TOUCH_VIDEO if t not in ("video_pause", "video_resume"))

# --- fixed values: pages and tab targets ---------------------------------------
VIDEO_PAGES = ("2", "video", "page:main, subPage:video")
EAT_PAGES = ("eat", "3", "page:main, subPage:eat", "28")
PLAY_PAGES = ("play", "4", "page:main, subPage:play")
TRIP_PAGES = ("trip", "1")
ACTIVITY_PAGES = ("21", "33", "34", "35", "36", "37", "41")
AROUND_PAGES, POPULAR_PAGES, TAXI_VIDEO_PAGES, SAVER_PAGES = ("38",), ("5", "6"), ("40",), ("0",)


def tab_targets(name: str) -> tuple[str, str]:
    """The two spellings of a tab target."""
    return (f"targetPage: main ,targetSubPage: {name}", name)


# --- fixed values: thresholds and start dates -----------------------------------
TRIP_MIN_VERSION = 179
CLICK_MIN_VERSION = 204
SPECIAL_CITY = 310100  # city whose ad count is stream + screensaver
EVENT_HISTORY_START = dt.date(2019, 5, 11)
SCALE_HISTORY_START = dt.date(2019, 8, 12)

# Last day assumed loaded when a sink is still empty.
DEFAULT_HIGH_WATER_MARK = {
    "content_play_day": dt.date(2019, 8, 19),
    "ad_play_day": dt.date(2019, 11, 10),
    "ad_play_fulltime": dt.date(2019, 12, 12),
    "ad_plan_day": dt.date(2019, 12, 31),
    "trip_day": dt.date(2019, 8, 19),
    "tab_click": dt.date(2019, 8, 31),
    "video_click": dt.date(2019, 11, 30),
    "scan_extract": dt.date(2019, 9, 30),
    "interaction_day": dt.date(2019, 8, 31),
    "taxi_interaction_day": dt.date(2020, 1, 19),
    "calendar": dt.date(2019, 8, 1),
    "device_scale": dt.date(2019, 7, 31),
    "agent_day": dt.date(2019, 12, 10),
}
