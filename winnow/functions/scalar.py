"""Column expressions: dates, names, bins, ratios. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

# Segment edges and labels.
SEGMENT_EDGES = (0.0, 0.25, 0.75, 1.0)
SEGMENT_LABELS = ("Low", "Medium", "High")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a naive timestamp (session zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def day_number(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("long")


# ---------------------------------------------------------------- dates


def temporal_parts(ts: Column, prefix: str = "lead_") -> list[Column]:
    weekday = F.weekday(ts)
    return [
        F.year(ts).alias(f"{prefix}year"),
        F.month(ts).alias(f"{prefix}month"),
        F.quarter(ts).alias(f"{prefix}quarter"),
        F.weekofyear(ts).alias(f"{prefix}weekofyear"),
        weekday.alias(f"{prefix}weekday"),
        (weekday >= 5).cast("int").alias("is_weekend"),
    ]


def season(ts: Column) -> Column:
    quarter = F.floor((F.month(ts) % 12) / 3)
    return (
        F.when(quarter == 0, "Winter").when(quarter == 1, "Spring").when(quarter == 2, "Summer").when(quarter == 3, "Fall")
    )


def month_part(ts: Column) -> Column:
    day, length = F.dayofmonth(ts), F.dayofmonth(F.last_day(ts))
    return F.when(day * 3 <= length, "Early").when(day * 3 <= 2 * length, "Mid").when(day.isNotNull(), "Late")


def day_part(ts: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when(hour < 6, "Night").when(hour < 12, "Morning").when(hour < 18, "Afternoon").when(hour < 24, "Evening")
    )


def temporal_buckets(ts: Column, name: str) -> list[Column]:
    """The full set of derived date columns, prefixed with the date column's name."""
    weekday = F.weekday(ts)
    return [
        F.year(ts).alias(f"{name}_Year"),
        F.month(ts).alias(f"{name}_Month"),
        F.dayofmonth(ts).alias(f"{name}_Day"),
        weekday.alias(f"{name}_DayOfWeek"),
        F.quarter(ts).alias(f"{name}_Quarter"),
        F.dayofyear(ts).alias(f"{name}_DayOfYear"),
        F.weekofyear(ts).alias(f"{name}_WeekOfYear"),
        F.date_format(ts, "yyyyMM").alias(f"{name}_YearMonth"),
        (weekday >= 5).cast("int").alias(f"{name}_IsWeekend"),
        (weekday < 5).cast("int").alias(f"{name}_IsBusinessDay"),
        season(ts).alias(f"{name}_Season"),
        month_part(ts).alias(f"{name}_MonthPart"),
        day_part(ts).alias(f"{name}_DayPart"),
    ]


def parse_yearmonth(value: Column) -> Column:
    """``52024`` or ``122024`` -> first of the month; anything else -> NULL."""
    text = F.trim(value.cast("string"))
    year = F.right(text, F.lit(4))
    month = F.substring(text, F.lit(1), F.greatest(F.length(text) - 4, F.lit(0)))
    return F.try_to_timestamp(F.concat(year, F.lpad(month, 2, "0"), F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


# ---------------------------------------------------------------- text


# Characters a feature name must not hold.
UNSAFE_NAME_CHARACTERS = "\"{}[]&%+'\\/<>*^|?!"


def clean_name(value: Column) -> Column:
    """JSON-special characters and blanks to ``_``, runs collapsed, ends stripped."""
    unsafe = "".join("\\" + c for c in UNSAFE_NAME_CHARACTERS)
    body = F.regexp_replace(value, f"[{unsafe}\\s_]+", "_")
    body = F.regexp_replace(body, "^_|_$", "")
    return F.when(body == "", "feature").otherwise(body)


def null_literal(value: Column) -> Column:
    return F.nullif(value, F.lit("NULL"))


# ---------------------------------------------------------------- numbers


def clip(value: Column, low, high) -> Column:
    """NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


# ---------------------------------------------------------------- bins


def check_edges(edges: Sequence[float], labels: Sequence[str]) -> None:
    if len(edges) != len(labels) + 1:
        raise ValueError(f"{len(labels)} labels need {len(labels) + 1} edges, got {len(edges)}")
    if list(edges) != sorted(set(edges)):
        raise ValueError("edges must increase strictly")


def assign_segment(p: Column, edges: Sequence[float] = SEGMENT_EDGES, labels: Sequence[str] = SEGMENT_LABELS) -> Column:
    """Left-closed bins ``[a, b)``; values beyond either end go to the end bin."""
    check_edges(edges, labels)
    out = F.when(p.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:-1], labels):
        out = out.when(p < edge, label)
    return out.otherwise(labels[-1])


def cut_right_closed(
    p: Column, edges: Sequence[float] = SEGMENT_EDGES, labels: Sequence[str] = SEGMENT_LABELS,
    include_lowest: bool = False,
) -> Column:
    """Bins ``(a, b]``; values outside (and the lowest edge, unless included) -> NULL."""
    check_edges(edges, labels)
    outside = (p < edges[0]) if include_lowest else (p <= edges[0])
    out = F.when(p.isNull() | outside | (p > edges[-1]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(p <= edge, label)
    return out


def right_closed_index(p: Column, edges: Sequence[float]) -> Column:
    """Index of the bin ``(a, b]``, the lowest edge included in bin 0."""
    return cut_right_closed(p, edges, [str(i) for i in range(len(edges) - 1)], include_lowest=True).cast("int")


def equal_width_bin(p: Column, bins: int = 10) -> Column:
    """``floor(p*bins)`` with the top value in the last bin."""
    return clip(F.floor(p * bins).cast("int"), 0, bins - 1)
