"""Back-off, time-outs, lag and durations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def backoff_ms(attempt: Column, base_ms: int, cap_ms: int) -> Column:
    """base * 2^(attempt - 1), at most cap; attempts count from 1."""
    return F.least(F.lit(base_ms) * F.pow(F.lit(2.0), F.least(attempt, F.lit(50)) - 1), F.lit(float(cap_ms))).cast("bigint")


def jittered(delay_ms: float, draw: float, share: float = 0.2, floor_ms: float = 1.0) -> float:
    """Delay moved by up to `share` either way; draw from 0 to 1."""
    return max(floor_ms, delay_ms * (1 + share * (2 * draw - 1)))


def transform_timeout_ms(batch: Column) -> Column:
    return F.greatest(F.lit(15_000), batch * 5)


def ack_wait_ms(batch: Column) -> Column:
    """Time to process a batch of requests one by one, plus 10 s, from 30 s to 10 min."""
    return F.least(F.greatest(batch * transform_timeout_ms(batch) + 10_000, F.lit(30_000)), F.lit(600_000))


def lag_ms(now: Column, ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", ts, now)


def rfc3339(ts: Column) -> Column:
    """A time as RFC 3339 text in UTC, with as many digits of the second as it has and no trailing zeros."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ""), F.lit("Z"))


# Units of duration texts in nanoseconds.
UNITS = {"ns": 1, "us": 1_000, "µs": 1_000, "ms": 1_000_000, "s": 1_000_000_000, "m": 60_000_000_000, "h": 3_600_000_000_000}
_SPAN = re.compile(r"(\d+(?:\.\d*)?|\.\d+)(ns|us|µs|ms|s|m|h)")


def parse_duration(value: str | int) -> int:
    """Nanoseconds of texts like 1h30m or 500ms; numbers are nanoseconds already."""
    if isinstance(value, int):
        return value
    sign, text = (-1, value[1:]) if value.startswith("-") else (1, value.removeprefix("+"))
    if text == "0":
        return 0
    found, at = 0, 0
    for m in _SPAN.finditer(text):
        if m.start() != at:
            break
        found += round(float(m[1]) * UNITS[m[2]])
        at = m.end()
    if not text or at != len(text):
        raise ValueError(f"not a duration: {value!r}")
    return sign * found


def format_duration(ns: int) -> str:
    """The shortest usual text: hours, minutes and seconds, or one smaller unit below a second."""
    if ns == 0:
        return "0s"
    sign, ns = ("-", -ns) if ns < 0 else ("", ns)
    for unit in ("ns", "µs", "ms"):
        if ns < UNITS["s"] and ns < 1000 * UNITS[unit]:
            return f"{sign}{ns / UNITS[unit]:.9f}".rstrip("0").rstrip(".") + unit
    h, rest = divmod(ns, UNITS["h"])
    m, rest = divmod(rest, UNITS["m"])
    seconds = f"{rest / UNITS['s']:.9f}".rstrip("0").rstrip(".") + "s"
    return sign + (f"{h}h{m}m" if h else f"{m}m" if m else "") + seconds
