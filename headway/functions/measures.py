"""Availability, arrival and status measures (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL when the whole is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def occupancy_pct(bikes: Column, ebikes: Column, docks: Column, digits: int = 1) -> Column:
    """Rounded share of docks holding any bike.

    Summed as doubles: two INT counts could overflow under ANSI rules.
    """
    held = bikes.cast("double") + ebikes.cast("double")
    return F.round(F.try_divide(held * F.lit(100.0), docks.cast("double")), digits)


def fill_pct(bikes: Column, docks: Column) -> Column:
    """Unrounded share of docks holding a pedal bike."""
    return share(bikes, docks) * F.lit(100.0)


def holds_nothing(bikes: Column, ebikes: Column | None = None) -> Column:
    """True when no bike is left; the batch tables ignore e-bikes."""
    return bikes == 0 if ebikes is None else (bikes + ebikes) == 0


def no_free_dock(empty_docks: Column) -> Column:
    return empty_docks == 0


def at_capacity(bikes: Column, docks: Column) -> Column:
    return bikes == docks


def availability_status(bikes: Column, docks: Column) -> Column:
    """critical, low, full or normal; an unknown share counts as normal."""
    ratio = share(bikes, docks)
    return (
        F.when(ratio < 0.1, "critical").when(ratio < 0.3, "low").when(ratio > 0.9, "full").otherwise("normal")
    )


def arrival_status(seconds: Column) -> Column:
    """due, arriving or scheduled; an unknown time counts as scheduled."""
    return F.when(seconds <= 60, "due").when(seconds <= 300, "arriving").otherwise("scheduled")


def has_arrived(seconds: Column) -> Column:
    return seconds <= 0


def line_rag(status: Column) -> Column:
    """Traffic-light colour of a status text; an unknown text is red."""
    return (
        F.when(status == "Good Service", "green")
        .when(status.isin("Minor Delays", "Reduced Service"), "amber")
        .otherwise("red")
    )


def status_tone(severity: Column, planned_first: bool = False) -> Column:
    """Coarse tone of a severity code.

    By default codes of 19 and 20 read as "major", as the source's test order has it;
    ``planned_first`` gives them the tone they were meant to have.
    """
    tone = F.when(severity.isNull(), "unknown")
    if planned_first:
        tone = tone.when(severity >= 19, "planned")
    return (
        tone.when(severity == 10, "good")
        .when(severity == 9, "minor")
        .when(severity >= 6, "major")
        .otherwise("severe")
    )


def floor_at(value: Column, low: int = 0) -> Column:
    """Values below ``low`` become ``low``; NULL stays NULL, unlike with greatest()."""
    return F.when(value < low, F.lit(low)).otherwise(value)


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def whole_percent(value: Column) -> Column:
    """Halves round up."""
    return F.floor(value + F.lit(0.5))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)
