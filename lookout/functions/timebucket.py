"""Time buckets: longs of the form yyyyMMdd[HH[mm[ss]]] beside ordinary timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# digits in the bucket for each step
DIGITS = {"day": 8, "hour": 10, "minute": 12, "second": 14}
FORMAT = {"day": "yyyyMMdd", "hour": "yyyyMMddHH", "minute": "yyyyMMddHHmm", "second": "yyyyMMddHHmmss"}
STEP_SECONDS = {"day": 86400, "hour": 3600, "minute": 60, "second": 1}


def bucket_of(ts: Column, step: str = "minute") -> Column:
    """Timestamp to bucket by integer arithmetic, which stays in generated code."""
    out = F.year(ts).cast("bigint") * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    for unit, extract in (("hour", F.hour), ("minute", F.minute), ("second", F.second)):
        if DIGITS[step] >= DIGITS[unit]:
            out = out * 100 + extract(ts)
    return out


def bucket_of_millis(ms: Column, step: str = "minute") -> Column:
    return bucket_of(F.timestamp_millis(ms), step)


def to_ts(bucket: Column, step: str | None = None) -> Column:
    """Bucket back to the timestamp of its start; the step is read from the digits when not given."""
    if step is None:
        padded = F.rpad(bucket.cast("string"), 14, "0")
    else:
        padded = F.rpad(bucket.cast("string"), 14, "0") if step != "second" else bucket.cast("string")
    return F.to_timestamp(padded, "yyyyMMddHHmmss")


def kind_of(bucket: Column) -> Column:
    n = F.length(bucket.cast("string"))
    return (F.when(n == 14, "second").when(n == 12, "minute").when(n == 10, "hour").when(n == 8, "day")
            .otherwise("unknown"))


def coarsen(bucket: Column, levels: int = 1) -> Column:
    """minute to hour (1 level) or to day (2 levels)."""
    return F.call_function("div", bucket, F.lit(100 ** levels).cast("bigint"))


def minutes_in(bucket: Column) -> Column:
    n = F.length(bucket.cast("string"))
    return F.when(n == 8, 1440).when(n == 10, 60).otherwise(1).cast("bigint")


def day_start(bucket: Column) -> Column:
    """First minute bucket of the day a minute bucket lies in."""
    return coarsen(bucket, 2) * 10000


def day_end(bucket: Column) -> Column:
    return coarsen(bucket, 2) * 10000 + 2359


# Text form of a query time at each step.
TEXT_FORMAT = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH", "minute": "yyyy-MM-dd HHmm", "second": "yyyy-MM-dd HHmmss"}


def parse_text(c: Column, step: str) -> Column:
    """Query time text to the timestamp of its start; text in another form gives null."""
    return F.try_to_timestamp(c, F.lit(TEXT_FORMAT[step]))


def last_second(c: Column, step: str) -> Column:
    """Second bucket that ends the step which a query time text names."""
    return bucket_of(F.timestamp_seconds(F.unix_seconds(parse_text(c, step)) + STEP_SECONDS[step] - 1), "second")


# ---- literals, evaluated while the plan is built ----

_UNIT_MS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}


def parse_range_ms(text: str) -> int:
    """``100ms``, ``5m``, ``1h30m`` or an ISO ``PT1M`` duration, in milliseconds."""
    iso = re.fullmatch(r"P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?", text.upper())
    if iso and any(iso.groups()):
        d, h, m, s = (int(g or 0) for g in iso.groups())
        return (((d * 24 + h) * 60 + m) * 60 + s) * 1000
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|us|µs|ns|[smhdw])", text)
    if not parts or "".join(a + b for a, b in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    sub = {"us": 1e-3, "µs": 1e-3, "ns": 1e-6}
    return int(sum(float(n) * (sub[u] if u in sub else _UNIT_MS[u]) for n, u in parts))


_PY_FORMAT = {"DAY": "%Y-%m-%d", "HOUR": "%Y-%m-%d %H", "MINUTE": "%Y-%m-%d %H%M", "SECOND": "%Y-%m-%d %H%M%S"}


class Duration:
    """A query range: step plus inclusive start and end, written as the step's own text format."""

    def __init__(self, start: str, end: str, step: str):
        from datetime import datetime, timezone

        self.step = step.upper()
        if self.step not in _PY_FORMAT:
            raise ValueError(f"unknown step {step}")
        parse = lambda s: datetime.strptime(s, _PY_FORMAT[self.step]).replace(tzinfo=timezone.utc)
        self.start, self.end = parse(start), parse(end)
        if self.end < self.start:
            raise ValueError("end before start")

    @property
    def step_seconds(self) -> int:
        return STEP_SECONDS[self.step.lower()]

    def _bucket(self, t) -> int:
        return int(t.strftime("%Y%m%d%H%M%S")[: DIGITS[self.step.lower()]])

    @property
    def start_bucket(self) -> int:
        return self._bucket(self.start)

    @property
    def end_bucket(self) -> int:
        return self._bucket(self.end)

    @property
    def second_range(self) -> tuple[int, int]:
        """First and last second bucket covered, used for record tables."""
        from datetime import timedelta

        last = self.end + timedelta(seconds=self.step_seconds - 1)
        return int(self.start.strftime("%Y%m%d%H%M%S")), int(last.strftime("%Y%m%d%H%M%S"))

    @property
    def points(self) -> int:
        return int((self.end - self.start).total_seconds()) // self.step_seconds + 1

    def widened(self, steps: int) -> "Duration":
        """The same range starting ``steps`` earlier, as trend functions need."""
        from datetime import timedelta

        out = object.__new__(Duration)
        out.step, out.end = self.step, self.end
        out.start = self.start - timedelta(seconds=steps * self.step_seconds)
        return out

    def grid(self, spark):
        """One row per expected time bucket. The row count is the number of points on a chart axis."""
        s = int(self.start.timestamp())
        return (spark.range(self.points)
                .select(bucket_of(F.timestamp_seconds(F.lit(s) + F.col("id") * self.step_seconds),
                                  self.step.lower()).alias("time_bucket")))
