"""Column expressions used across operators. All stay inside codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from probewatch.schemas import DEC, DEFAULT_ERROR_TEXT, SLOW_MS

COUNT_DEC = "decimal(20,0)"


def number_of(text: Column) -> Column:
    """Text to a finite number; NULL for other text, NaN and infinities."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def ms_from_epoch(seconds: Column) -> Column:
    """Fractional epoch seconds to whole milliseconds; NULL where they have none."""
    return F.round(number_of(seconds.cast("string")) * 1000).try_cast("long")


def timestamp_from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def state_from_value(value: Column) -> Column:
    """Sample value text to the integer state; NULL for text that is no finite number."""
    return F.floor(number_of(value)).try_cast("int")


def latency_from_seconds(seconds: Column) -> Column:
    """Probe duration in seconds to milliseconds with six decimals; NULL if unreadable."""
    return F.round(number_of(seconds) * 1000, 6).try_cast(DEC)


# Fixed pattern: everything before the last colon is the host.
INSTANCE_PATTERN = r"^(.*):([0-9]+)$"


def host_of(instance: Column) -> Column:
    host = F.regexp_extract(instance, INSTANCE_PATTERN, 1)
    return F.when(instance.rlike(INSTANCE_PATTERN), host).otherwise(instance)


def port_text_of(instance: Column) -> Column:
    """Digits after the last colon, empty when there are none."""
    return F.regexp_extract(instance, INSTANCE_PATTERN, 2)


def default_error(is_up: Column, error_text: Column | None = None) -> Column:
    given = error_text if error_text is not None else F.lit(None).cast("string")
    return F.when(is_up != 1, F.coalesce(given, F.lit(DEFAULT_ERROR_TEXT)))


def is_slow(slow_ms=SLOW_MS) -> Column:
    """Three-valued: NULL when an UP sample carries no latency."""
    return (F.col("is_up") == 1) & (F.col("latency_ms") > F.lit(slow_ms))


def availability_pct(up: Column, probes: Column) -> Column:
    up, probes = up.cast(COUNT_DEC), probes.cast(COUNT_DEC)
    return F.round(up * 100 / F.nullif(probes, F.lit(0).cast(COUNT_DEC)), 2)


def mean_latency(total: Column, count: Column) -> Column:
    count = count.cast(COUNT_DEC)
    return F.round(total / F.nullif(count, F.lit(0).cast(COUNT_DEC)), 2)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact difference in seconds with six decimals."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")


def whole_seconds_between(later: Column, earlier: Column) -> Column:
    """Difference rounded (not truncated) to whole seconds."""
    return F.round(seconds_between(later, earlier), 0).cast("long")


def event_status(end: Column) -> Column:
    return F.when(end.isNull(), F.lit("OPEN")).otherwise(F.lit("CLOSED"))


def state_text(value: Column) -> Column:
    return F.when(value == 1, F.lit("UP")).when(value == 0, F.lit("DOWN"))


# Fixed thresholds: (lower bound, grade) in ascending order; the first has no bound.
GRADES = {
    "availability": [(None, "red"), (95, "yellow"), (99, "green")],
    "latency_seconds": [(None, "green"), (1, "yellow"), (3, "red")],
    "down_now": [(None, "green"), (1, "red")],
    "slow_now": [(None, "green"), (1, "red")],
    "down_group": [(None, "green"), (1, "yellow"), (3, "red")],
}


def grade(value: Column, kind: str) -> Column:
    steps = GRADES[kind]
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in reversed(steps[1:]):
        out = out.when(value >= bound, F.lit(name))
    return out.otherwise(F.lit(steps[0][1]))


def label_matches(column: Column, pattern: str) -> Column:
    """Anchored regex match; an absent label behaves as the empty string."""
    text = F.coalesce(column, F.lit(""))
    if pattern == ".*":
        return F.lit(True)
    if re.fullmatch(r"[\w \-]+(\|[\w \-]+)*", pattern):
        return text.isin(pattern.split("|"))  # plain names: pushable to the scan
    return text.rlike(f"^(?:{pattern})$")
