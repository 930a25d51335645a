"""Confidence tiers, boosts and other scores of frequencies, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class TierProfile:
    """Least frequencies of tiers from the highest down, the tier below them, and each tier's boost."""

    cuts: tuple[tuple[str, float], ...]
    rest: str
    boosts: dict[str, float]
    few_checklists: int = 0  # cells with fewer checklists have the lowest tier only


# Cut-offs and boosts of the two published profiles, and penalties by resolution.
CODE = TierProfile((("common", 0.10), ("uncommon", 0.01), ("rare", 0.001)), "vagrant", {"common": 1.5, "uncommon": 1.2, "rare": 1.0, "vagrant": 0.8})
DOC = TierProfile((("common", 0.20), ("uncommon", 0.05), ("rare", 0.01)), "vagrant", {"common": 1.2, "uncommon": 1.05, "rare": 1.0, "vagrant": 0.9}, 20)
PENALTIES = {5: 1.0, 4: 0.8, 2: 0.5}
TIERS = ("common", "uncommon", "rare", "vagrant")


def choice(column: Column, values: dict, default) -> Column:
    """The value for the column's key, or the default."""
    out = F.lit(default)
    for key, value in reversed(values.items()):
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def tier(frequency: Column, profile: TierProfile = CODE, checklists: Column | None = None) -> Column:
    out = F.lit(profile.rest)
    for name, least in reversed(profile.cuts):
        out = F.when(frequency >= least, F.lit(name)).otherwise(out)
    return out if checklists is None or not profile.few_checklists else F.when(checklists < profile.few_checklists, F.lit(profile.rest)).otherwise(out)


def boost(tier_name: Column, resolution: Column, profile: TierProfile = CODE) -> Column:
    return choice(tier_name, profile.boosts, 1.0) * choice(resolution, PENALTIES, 1.0)


def linear_boost(frequency: Column, most: float = 1.3) -> Column:
    """From 1 at no frequency to most at a frequency of 1, kept between these."""
    return F.greatest(F.lit(1.0), F.least(F.lit(most), 1.0 + frequency * (most - 1.0)))


def seasonal_boost(monthly: Column, yearly: Column) -> Column:
    """Half of what a month's frequency is above the year's, on top of 1."""
    return F.when(monthly > yearly, 1.0 + (monthly - yearly) * 0.5).otherwise(F.lit(1.0))


def quality(checklists: Column) -> Column:
    return F.least(F.lit(1.0), checklists / F.lit(100.0))


def pack_size_mb(checklists: Column) -> Column:
    """Estimated size of a pack: half a megabyte and 0.05 for each thousand checklists, 200 at most."""
    return F.bround(F.least(F.lit(0.5) + checklists / F.lit(1000.0) * F.lit(0.05), F.lit(200.0)), 3)


def modelled_size(cells: Column, boundary: Column, data: Column, taxa: Column, bytes_each: float, ratio: float) -> Column:
    """Bytes of a pack: cells times seven for each finer level, times taxa, bytes for each and the compression."""
    return cells * F.pow(F.lit(7.0), data - boundary) * taxa * F.lit(bytes_each) * F.lit(ratio)


def data_resolution(checklists: Column) -> Column:
    """The finest level that so many checklists support."""
    return F.when(checklists >= 100_000, F.lit(6)).when(checklists >= 10_000, F.lit(5)).otherwise(F.lit(4))


def wilson(hits: Column, total: Column, z: float = 1.96) -> tuple[Column, Column, Column]:
    """Standard error, lower and upper bound of a share; nulls when total is 0."""
    n, p = total.cast("double"), F.when(total > 0, hits.cast("double") / total)
    error = F.sqrt(p * (1 - p) / n)
    centre, width = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return error, (centre - width) / (1 + z * z / n), (centre + width) / (1 + z * z / n)


def adjusted(confidence: Column, boost_: Column, tier_name: Column, vagrant_floor: float = 0.95) -> Column:
    """A detection's confidence by what is known of its taxon there; null where it is suppressed.

    Common and uncommon taxa are boosted to 1 at most, rare ones stay, vagrants lose a tenth. Vagrants below
    the floor are suppressed, and so are taxa that are not known there (a null tier), which stay above it."""
    shown = confidence >= vagrant_floor
    return (
        F.when(tier_name.isin("common", "uncommon"), F.least(F.lit(1.0), confidence * boost_))
        .when(tier_name == "rare", confidence)
        .when((tier_name == "vagrant") & shown, confidence * 0.9)
        .when(tier_name.isNull() & shown, confidence)
    )


def month_of_week(week: Column) -> Column:
    """Four weeks a month, the rest in December."""
    return F.least(F.lit(12), F.ceil(week / F.lit(4.0)).cast("int"))


# The first week of each month in the irregular calendar of the pack format, from 1 to 48.
WEEK_STARTS = (1, 5, 9, 14, 18, 22, 27, 31, 36, 40, 44)


def month_of_week_irregular(week: Column) -> Column:
    """The pack format's calendar, in which only weeks outside of 1 to 48 are in December."""
    return F.when(~week.between(1, 48), F.lit(12)).otherwise(_months_begun(week))


def _months_begun(week: Column) -> Column:
    return sum((F.when(week >= start, F.lit(1)).otherwise(F.lit(0)) for start in WEEK_STARTS), F.lit(0))
