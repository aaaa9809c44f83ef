"""Recency windows and row predicates (FLT1-FLT13, FLT15).

Each rule is a boolean Column built from an explicit ``as_of`` instant, so a
filter is a plain ``df.filter`` that Catalyst can push towards the scan.  The
rules differ on purpose, including on what an unknown date (null) means.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_lit, parse_lastmod_strict, url_date

RULES = ("midnight", "age", "calendar", "age_or_now", "days_floor",
         "lastmod_or_url", "min_date")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def is_recent(ts, as_of, days: int, rule: str = "age", keep_unknown: bool | None = None,
              url=None) -> Column:
    """Boolean Column: is the (instant) ``ts`` within ``days`` of ``as_of`` under ``rule``.

    midnight    FLT1  ts >= midnight(as_of) - N days; unknown kept
    age         FLT2  ts >= as_of - N days (exact); unknown dropped
    calendar    FLT3  datediff(date(as_of), date(ts)) <= N; unknown dropped
    age_or_now  FLT4  unknown counts as as_of, i.e. kept
    days_floor  FLT5  floor((as_of - ts) / 1 day) <= N; unknown kept unless keep_unknown=False
    lastmod_or_url FLT6  strict lastmod formats if a lastmod is given, else the date in the URL path
    min_date    FLT7  as age_or_now
    """
    now = as_of_lit(as_of)
    t = _c(ts)
    if rule == "midnight":
        cond = t >= F.date_trunc("day", now) - _days(days)
        default = True
    elif rule == "age":
        cond = t >= now - _days(days)
        default = False
    elif rule == "calendar":
        cond = F.datediff(F.to_date(now), F.to_date(t)) <= days
        default = False
    elif rule in ("age_or_now", "min_date"):
        cond = F.coalesce(t, now) >= now - _days(days)
        default = True
    elif rule == "days_floor":
        micros = F.unix_micros(now) - F.unix_micros(t)
        cond = F.floor(micros / F.lit(86_400_000_000)) <= days
        default = True
    elif rule == "lastmod_or_url":
        raw = t
        given = raw.isNotNull() & (F.trim(raw) != "")
        cutoff = now - _days(days)
        by_lastmod = F.coalesce(parse_lastmod_strict(raw) >= cutoff, F.lit(False))
        by_url = F.coalesce(url_date(url) >= cutoff, F.lit(False))
        return F.when(given, by_lastmod).otherwise(by_url)
    else:
        raise ValueError(f"unknown recency rule {rule!r}; expected one of {RULES}")
    if keep_unknown is not None:
        default = keep_unknown
    return F.coalesce(cond, F.lit(default))


def recent(df: DataFrame, ts, as_of, days: int, rule: str = "age", **kw) -> DataFrame:
    """Rows of ``df`` kept by the recency ``rule``."""
    return df.filter(is_recent(ts, as_of, days, rule, **kw))


def is_today(ts, as_of) -> Column:
    """FLT8: same UTC calendar day as as_of; unknown dropped."""
    return F.coalesce(F.to_date(_c(ts)) == F.to_date(as_of_lit(as_of)), F.lit(False))


def _packed(dt: _dt.datetime) -> int:
    return int(dt.strftime("%Y%m%d%H"))


def hour_bounds(as_of, delay_hours: int) -> tuple[int, int]:
    """Packed yyyyMMddHH bounds of the run window (as_of - delay ... as_of), both inclusive."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    start = as_of - _dt.timedelta(hours=int(delay_hours))
    return _packed(start), _packed(as_of)


def packed_partition_hour(year="year", month="month", day="day", hour="hour") -> Column:
    """int(concat(year, month, day, hour)) over string partition columns; bad -> null."""
    return F.concat(_c(year), _c(month), _c(day), _c(hour)).try_cast("int")


def in_hour_window(as_of, delay_hours: int, **cols) -> Column:
    """FLT9: packed partition hour between the window bounds (literal ints -> partition filter)."""
    lo, hi = hour_bounds(as_of, delay_hours)
    p = packed_partition_hour(**cols)
    return p.between(F.lit(lo), F.lit(hi))


def instant_bounds(ts, as_of, delay_hours: int, slack_hours: int = 14) -> Column:
    """A coarse, pushable superset of FLT9 on the raw event time: the local-hour window
    widened by ``slack_hours`` (larger than any zone offset) on both sides.  Used next to
    the exact local-hour predicate so the scan can skip row groups."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    lo = as_of - _dt.timedelta(hours=int(delay_hours) + slack_hours)
    hi = as_of + _dt.timedelta(hours=1 + slack_hours)
    t = _c(ts)     # raw event time as stored (timestamp_ntz, UTC wall clock)
    return (t >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")) & \
        (t < F.lit(hi.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))


def hour_window(df: DataFrame, as_of, delay_hours: int) -> DataFrame:
    """FLT9 as a DataFrame filter; on a partitioned table it becomes a PartitionFilter."""
    return df.filter(in_hour_window(as_of, delay_hours))


def http_only(c) -> Column:
    """FLT10: URL starts with http:// or https://; null dropped."""
    return F.coalesce(_c(c).rlike("^https?://"), F.lit(False))


ERROR_MARKER = "error_url_report"


def split_rejects(df: DataFrame, col: str = "data") -> tuple[DataFrame, DataFrame]:
    """FLT11: (good, rejects) as two filters of the same parent.

    Both sides read ``df``; callers persist or stage ``df`` first when it is
    expensive (page extraction).  Null payloads count as rejects.
    """
    bad = F.coalesce(F.col(col).contains(ERROR_MARKER), F.lit(True))
    return df.filter(~bad), df.filter(bad)


def has_identity_and_time(url="og.url", times=("article.published_time", "og.published_time",
                                                "og.modified_time", "article.modified_time")) -> Column:
    """FLT12: identity URL present and at least one of the four times present."""
    def q(c):
        return F.col(f"`{c}`") if isinstance(c, str) else c
    return q(url).isNotNull() & F.coalesce(*[q(t) for t in times]).isNotNull()


def split_null_lastmod(df: DataFrame, as_of, lastmod="lastmod",
                       pub="news:news.news:publication_date") -> tuple[DataFrame, DataFrame]:
    """FLT13: (with lastmod, without lastmod and published before the end of the run hour)."""
    end = F.date_trunc("hour", as_of_lit(as_of)) + F.expr("INTERVAL 1 HOUR")
    has = df.filter(F.col(lastmod).isNotNull())
    missing = df.filter(F.col(lastmod).isNull() & (F.col(pub).try_cast("timestamp") < end))
    return has, missing


def missing_fields(required=("name", "url", "sitemap", "is_own_site")) -> Column:
    """FLT15: array of required field names that are null on the row (empty = complete)."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required]))
