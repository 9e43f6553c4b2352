"""Declarative report specifications."""

from __future__ import annotations

from dataclasses import dataclass

from footfall.operators.rollup import CUBE_LEVELS, LINK_LEVELS
from footfall.operators.traffic import Levels

COUNTS = ("new_comer_count", "visitor_count", "open_count", "total_page_count", "total_stay_time", "one_page_count")
SCANS = ("new_comer_count", "visitor_count", "open_count")
ALL_RATIOS = ("avg_stay_time", "secondary_avg_stay_time", "bounce_rate")
VISIT_RATIOS = ("secondary_avg_stay_time", "bounce_rate")


@dataclass(frozen=True)
class ReportSpec:
    """One report family: which rows, by which dimensions, with which metrics."""

    name: str
    family: str
    levels: Levels
    metrics: tuple[str, ...] = COUNTS
    ratios: tuple[str, ...] = VISIT_RATIOS
    identity: str = "uu"
    drop_app_level: bool = True
    session_marks: bool = True
    auth: bool = False
    page_level: bool = False

    @property
    def dims(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(d for level in self.levels for d in level))


def _spec(name: str, family: str, *dims: str, **options) -> ReportSpec:
    return ReportSpec(name, family, (dims,), **options)


_LINK = {"auth": True}

REPORTS: dict[str, ReportSpec] = {
    spec.name: spec
    for spec in (
        _spec("daily_trend", "trend", "te", ratios=ALL_RATIOS),
        _spec("hourly_trend", "trend", "te", "hour", ratios=ALL_RATIOS),
        _spec("daily_scene", "scene", "te", "scene_group", "scene"),
        _spec("daily_scene_group", "scene", "te", "scene_group"),
        _spec("hourly_scene", "scene", "te", "hour", "scene_group", "scene"),
        _spec("hourly_scene_group", "scene", "te", "hour", "scene_group"),
        _spec("daily_qr", "qr", "te", "qr", metrics=SCANS, ratios=()),
        _spec("hourly_qr", "qr", "te", "hour", "qr", metrics=SCANS, ratios=()),
        _spec("daily_qr_group", "qr", "te", "qr_group", metrics=SCANS, ratios=()),
        _spec("hourly_qr_group", "qr", "te", "hour", "qr_group", metrics=SCANS, ratios=()),
        _spec("daily_link_summary", "link", **_LINK),
        _spec("hourly_link_summary", "link", "hour", **_LINK),
        _spec("daily_link", "link", "link_key", **_LINK),
        _spec("hourly_link", "link", "hour", "link_key", **_LINK),
        _spec("daily_media", "link", "media_id", **_LINK),
        _spec("hourly_media", "link", "hour", "media_id", **_LINK),
        _spec("daily_position", "link", "position_id", **_LINK),
        _spec("hourly_position", "link", "hour", "position_id", **_LINK),
        ReportSpec("link_monitor_cube", "link", CUBE_LEVELS, auth=True),
        ReportSpec("link_expansion", "link", LINK_LEVELS, auth=True),
        _spec("daily_city", "region", "city", drop_app_level=False),
        _spec("daily_province", "region", "province", drop_app_level=False),
        _spec("daily_brand", "phone", "brand", drop_app_level=False),
        _spec("daily_model", "phone", "model", drop_app_level=False),
    )
}

# Reports that share rows and enrichment run as several levels of one pass.
JOBS: dict[str, ReportSpec] = {
    spec.name: spec
    for spec in (
        ReportSpec("trend_job", "trend", (("te",), ("te", "hour")), ratios=ALL_RATIOS),
        ReportSpec(
            "scene_job", "scene",
            (("te", "scene_group", "scene"), ("te", "scene_group"),
             ("te", "hour", "scene_group", "scene"), ("te", "hour", "scene_group")),
        ),
        ReportSpec(
            "qr_job", "qr",
            (("te", "qr"), ("te", "hour", "qr"), ("te", "qr_group"), ("te", "hour", "qr_group")),
            metrics=SCANS, ratios=(),
        ),
        ReportSpec("region_job", "region", (("city",), ("province",)), drop_app_level=False),
        ReportSpec("phone_job", "phone", (("brand",), ("model",)), drop_app_level=False),
    )
}

TERMINAL_DIMS = ("lang", "nt", "sv", "wsdk", "wv", "wvv", "ww_wh")
TERMINAL = ReportSpec(
    "daily_terminal", "terminal", tuple((d,) for d in TERMINAL_DIMS),
    ratios=("secondary_avg_stay_time", "bounce_rate"),
    drop_app_level=False, session_marks=False, page_level=True,
)

AD_LEVELS: Levels = LINK_LEVELS[2:]
