"""Column functions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEMVER = r"^\d+\.\d+\.\d+$"
PAIR = r"^\s*\[\s*([-+.eE0-9]+)\s*,\s*([-+.eE0-9]+)\s*\]\s*$"
MAX_INPUT = 2048
MAX_LOG = 100


def truncate(text: Column, size: int = MAX_INPUT) -> Column:
    """Texts longer than ``size`` characters end in ``...``; null stays null."""
    return F.when(F.length(text) <= size, text).otherwise(
        F.concat(F.substring(text, 1, size), F.lit("..."))
    )


def stable_id(*parts: Column) -> Column:
    """An id that is the same on every replay of the same input."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def now_ms(now: Column | int | None = None) -> Column:
    """Epoch milliseconds of ``now``; the current time if not given."""
    if now is None:
        return F.unix_millis(F.current_timestamp())
    return now if isinstance(now, Column) else F.lit(now).cast("bigint")


def iso_instant(ms: Column) -> Column:
    """ISO-8601 text in UTC, whatever the session's time zone."""
    utc = F.to_utc_timestamp(F.timestamp_millis(ms), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def device_path(group: Column | str, device: Column) -> Column:
    return F.concat_ws(".", F.lit(group) if isinstance(group, str) else group, device)


def path_from_pattern(pattern: Column, device: Column) -> Column:
    """Fill the device id into a pattern such as ``root.sg.weather.${deviceId}``."""
    return F.replace(pattern, F.lit("${deviceId}"), device)


def device_id_of(text: Column) -> Column:
    """Best-effort device id from raw JSON text, in either vocabulary."""
    return F.coalesce(F.get_json_object(text, "$.machine_id"), F.get_json_object(text, "$.deviceId"))


def to_millis(ts: Column, unit: Column) -> Column:
    """Normalise a timestamp given in ms, s or us; an unknown unit counts as ms."""
    return (
        F.when(unit == "s", ts * 1000)
        .when(unit == "us", F.floor(ts / 1000).cast("bigint"))
        .otherwise(ts)
    )


def seconds_to_millis(seconds: Column) -> Column:
    """Seconds to whole milliseconds, truncating."""
    return (seconds * 1000).cast("bigint")


def severity_rank(severity: Column) -> Column:
    return (
        F.when(severity == "critical", 3).when(severity == "warning", 2)
        .when(severity == "info", 1).otherwise(0)
    )


def is_semver(text: Column) -> Column:
    return F.coalesce(text.rlike(SEMVER), F.lit(False))


def semver(text: Column) -> Column:
    """A version as a struct that orders by number; null if it is not ``n.n.n``."""
    part = F.split(text, r"\.")
    return F.when(
        is_semver(text),
        F.struct(*[F.get(part, F.lit(i)).try_cast("int").alias(n)
                   for i, n in enumerate(("major", "minor", "patch"))]),
    )


def duplicates(values: Column) -> Column:
    """The distinct values that occur more than once in an array, in order."""
    return F.array_sort(F.array_distinct(F.filter(
        values, lambda v: F.size(F.filter(values, lambda o: o == v)) > 1)))


def first_named(items: Column, field: str, name: Column | str) -> Column:
    """The first struct of an array whose ``field`` equals ``name``; null if there is none."""
    wanted = F.lit(name) if isinstance(name, str) else name
    return F.get(F.filter(items, lambda m: m[field] == wanted), F.lit(0))


def is_windowed(window: Column) -> Column:
    """Whether a rule is judged per window; one of type ``instant`` is not, whatever its size."""
    return F.coalesce(window["sizeSeconds"] > 0, F.lit(False)) & F.coalesce(window["type"] != "instant", F.lit(True))


def threshold_number(text: Column) -> Column:
    """A manifest threshold as one number; null if it is anything else."""
    return text.try_cast("double")


def threshold_range(text: Column) -> Column:
    """A manifest threshold as a struct ``lo, hi``; null unless it is a pair of numbers."""
    lo, hi = (F.regexp_extract(text, PAIR, i).try_cast("double") for i in (1, 2))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def join_errors(errors: Column) -> Column:
    return F.array_join(errors, ", ")
