"""Date and time functions (DAT1-DAT9) as Column expressions.

Conventions: the session clock is UTC (see ``session.REQUIRED_CONF``); parsed
values are ``timestamp`` (an instant); ``as_of`` is always an argument, never
the wall clock.  Every parse is a ``try_*`` so ANSI mode never fails a job on
bad input: unparseable -> null ("unknown").
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of) -> Column:
    """A literal instant from a datetime / ISO string / Column (UTC when naive)."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp")


def to_instant(c) -> Column:
    """timestamp_ntz/string/timestamp -> timestamp, reading naive values as UTC."""
    return _c(c).cast("timestamp")


# The zone names RFC 822 defines, as offsets.
RFC822_ZONES = {"GMT": "+0000", "UT": "+0000", "UTC": "+0000", "Z": "+0000",
                "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
                "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


def parse_rfc822(c) -> Column:
    """DAT1: RFC 822 ('Tue, 02 Jan 2024 10:00:00 +0100', 'GMT', 'EST', ...), else a plain cast.

    Zone names RFC 822 defines become offsets; any other trailing alphabetic zone name is
    ignored and the time read as UTC, as feed parsers do with names they do not know."""
    s = F.trim(_c(c))
    s = F.regexp_replace(s, "^[A-Za-z]{3},\\s*", "")
    zone = F.regexp_extract(s, "\\s([A-Za-z]{1,5})$", 1)
    zones = F.create_map(*[x for k, v in RFC822_ZONES.items() for x in (F.lit(k), F.lit(v))])
    offset = F.coalesce(F.element_at(zones, F.upper(zone)), F.lit("+0000"))
    s = F.when(zone != "", F.concat(F.regexp_replace(s, "\\s[A-Za-z]{1,5}$", ""), F.lit(" "), offset)).otherwise(s)
    rfc = F.coalesce(
        F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss")),
    )
    return F.coalesce(rfc, _c(c).try_cast("timestamp"))


def parse_iso_any(c) -> Column:
    """DAT2: ISO 8601 with zone or 'Z', without zone (read as UTC), or date only."""
    return F.trim(_c(c)).try_cast("timestamp")


def parse_any(c) -> Column:
    """ISO first, then RFC 822 (feed dates come in either form)."""
    return F.coalesce(parse_iso_any(c), parse_rfc822(c))


def parse_lastmod_strict(c) -> Column:
    """FLT6 formats: '%Y-%m-%dT%H:%M:%S%z', with '.%f', '%Y-%m-%d %H:%M:%S%z', '%Y-%m-%d'."""
    s = _c(c)
    fmts = [
        "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX",
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXX",
        "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXX",
        "yyyy-MM-dd",
    ]
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in fmts])


def url_date(url) -> Column:
    """DAT3: first valid /YYYY/M/D/ run of path pieces, as a UTC midnight timestamp."""
    from .urls import path_pieces

    p = path_pieces(url)
    # windows of three consecutive pieces, as one zipped array (no outer array inside a lambda)
    z = F.arrays_zip(p.alias("y"), F.slice(p, 2, 1 << 30).alias("m"), F.slice(p, 3, 1 << 30).alias("d"))

    def at(w):
        y, m, d = w["y"], w["m"], w["d"]
        ok = y.rlike("^[0-9]{4}$") & m.rlike("^[0-9]+$") & d.rlike("^[0-9]+$")
        yi, mi, di = y.try_cast("int"), m.try_cast("int"), d.try_cast("int")
        txt = F.format_string("%04d-%02d-%02d", yi, mi, di)
        return F.when(ok & (yi >= 1) & (mi <= 12) & (di <= 31),
                      F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")))

    cands = F.filter(F.transform(z, at), lambda x: x.isNotNull())
    return F.get(cands, 0)


def feed_date(*cols) -> Column:
    """DAT4: first parseable of the given fields (published, updated, created, date, dc:date)."""
    return F.coalesce(*[parse_any(c) for c in cols])


def strict_z(c, as_of) -> Column:
    """DAT5: "yyyy-MM-dd'T'HH:mm:ss'Z'" only, else as_of."""
    return F.coalesce(F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), as_of_lit(as_of))


def iso_format(ts) -> Column:
    """DAT6 formatting: Python ``isoformat()`` of a UTC instant ('+00:00' suffix)."""
    t = _c(ts)
    micro = F.date_format(t, "SSSSSS")
    return F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micro != "000000", F.concat(F.lit("."), micro)).otherwise(F.lit("")),
        F.lit("+00:00"),
    )


def iso_or_default(c, default=None) -> Column:
    """DAT6: parse then re-format; invalid -> default (as_of for articles, null elsewhere)."""
    parsed = parse_any(c)
    out = iso_format(parsed)
    if default is None:
        return out
    return F.coalesce(out, iso_format(as_of_lit(default)))


def local_part(ts, pattern: str, tz: str = "Europe/Rome") -> Column:
    """DAT7: a date_format part of the instant seen in zone ``tz``."""
    return F.date_format(F.from_utc_timestamp(_c(ts), tz), pattern)


def window_hours(as_of, delay_hours: int) -> Column:
    """DAT8: the hour starts (as_of - delay) ... (as_of - 1h), as an array."""
    end = F.date_trunc("hour", as_of_lit(as_of))
    return F.sequence(end - F.make_dt_interval(F.lit(0), F.lit(delay_hours)),
                      end - F.make_dt_interval(F.lit(0), F.lit(1)),
                      F.expr("INTERVAL 1 HOUR"))


def relative_bound(as_of, days: int) -> Column:
    """DAT9: 'now-Nd' style bound."""
    return as_of_lit(as_of) - F.make_dt_interval(F.lit(days))


# Units of a relative bound.
BOUND_UNITS = {"d": 86_400, "h": 3_600, "m": 60}


def relative_instant(c, as_of) -> Column:
    """DAT9: the instant that a bound like ``now``, ``now-1d`` or ``now-6h`` names (d, h, m; case and blanks around it
    don't matter); anything else is null."""
    s = F.lower(F.trim(_c(c)))
    pattern = "^now(?:([+-])([0-9]{1,6})([dhm]))?$"
    size = F.regexp_extract(s, pattern, 2).try_cast("bigint")
    unit = F.regexp_extract(s, pattern, 3)
    seconds = F.coalesce(size * F.coalesce(*(F.when(unit == u, F.lit(n)) for u, n in BOUND_UNITS.items())), F.lit(0))
    signed = F.when(F.regexp_extract(s, pattern, 1) == "-", -seconds).otherwise(seconds)
    now = as_of_lit(as_of)
    return F.when(s.rlike(pattern), F.timestamp_micros(F.unix_micros(now) + signed * 1_000_000))


def parse_sitemap_lastmod(c, keep_zone: bool = True) -> Column:
    """The lastmod parse of the 'midnight' rule (FLT1).

    'T' and ('+' or 'Z')  -> ISO 8601 with its zone; with ``keep_zone=False`` the zone is
                             dropped and the wall clock kept, as the reference does (B16)
    'T' only              -> strictly yyyy-MM-ddTHH:mm:ss, read as UTC
    otherwise             -> yyyy-MM-dd
    Anything else (a '-05:00' offset, fractions without a zone, ...) is unknown (null).
    """
    s = F.trim(_c(c))
    has_t = s.contains("T")
    zoned = s.contains("+") | s.contains("Z")
    if keep_zone:
        with_zone = s.try_cast("timestamp")
    else:
        wall = F.regexp_extract(s, "^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?)", 1)
        with_zone = F.nullif(wall, F.lit("")).try_cast("timestamp")
    return (F.when(has_t & zoned, with_zone)
            .when(has_t, F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
            .otherwise(F.try_to_timestamp(s, F.lit("yyyy-MM-dd"))))


def parse_20min_date(c) -> Column:
    """The two formats of the 20minutos rule (FLT5): '%Y-%m-%d %H:%M:%S%z', else '%Y-%m-%d'."""
    s = _c(c)
    return F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ssXXX")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ssXX")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd")))
