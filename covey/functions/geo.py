"""Places: distances, square cells, bands, the hierarchical hexagon index as bits, and continents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres along the great circle."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2.0)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def square_cell(lat: Column, lon: Column, step: float) -> tuple[Column, Column]:
    """South-west corner of the square of step degrees, by truncation towards 0."""
    cut = lambda x: (x / F.lit(step)).cast("long") * F.lit(step)
    return cut(lat), cut(lon)


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def inside_polygon(lat: Column, lon: Column, corners: list[tuple[float, float]]) -> Column:
    """Whether a point is in a polygon of (lat, lon) corners, by the parity of crossings."""
    crossings = F.lit(0)
    for (a_lat, a_lon), (b_lat, b_lon) in zip(corners, corners[1:] + corners[:1]):
        if a_lat == b_lat:
            continue  # a level edge is never crossed
        spans = (F.lit(a_lat) > lat) != (F.lit(b_lat) > lat)
        at = (lat - a_lat) * F.lit((b_lon - a_lon) / (b_lat - a_lat)) + a_lon
        crossings = crossings + F.when(spans & (lon < at), 1).otherwise(0)
    return crossings % 2 == 1


# Bounds of the nineteen latitude bands; the last holds the pole.
BANDS = (-90, -80, -70, -60, -50, -40, -30, -20, -10, 0, 10, 20, 30, 40, 45, 50, 60, 70, 80, 91)


def band(lat: Column) -> Column:
    """Name of the latitude band, as lat_n090_to_n080; n stands for minus and p for plus. Null outside."""
    name = lambda x: f"{'n' if x < 0 else 'p'}{abs(x):03d}"
    out = F.lit(None).cast("string")
    for low, high in zip(BANDS, BANDS[1:]):
        out = F.when((lat >= low) & (lat < high), F.lit(f"lat_{name(low)}_to_{name(high)}")).otherwise(out)
    return out


# Hexagon index: bits 52-55 resolution, 45-51 base cell, three bits for each digit from 15 levels, unused ones 7.
def resolution_of(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def parent(cell: Column, resolution: int) -> Column:
    """The cell at a coarser resolution that holds this one."""
    cleared = cell.bitwiseAND(F.lit(~(15 << 52)))
    return cleared.bitwiseOR(F.lit(resolution << 52)).bitwiseOR(F.lit((1 << 3 * (15 - resolution)) - 1))


#: Base cells that are pentagons: their children in direction 1 don't exist.
PENTAGONS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)


def child(cell: Column, resolution: int, digit: Column) -> Column:
    """The cell one level finer than resolution, in the direction of digit."""
    finer = resolution + 1
    cleared = cell.bitwiseAND(F.lit(~(15 << 52) & ~(7 << 3 * (15 - finer)))).bitwiseOR(F.lit(finer << 52))
    return cleared.bitwiseOR(F.call_function("shiftleft", digit.cast("long"), F.lit(3 * (15 - finer))))


def children(cell: Column, coarse: int, fine: int) -> Column:
    """All cells at resolution fine in a cell of resolution coarse, as an array."""
    out = F.array(cell)
    for level in range(coarse, fine):
        used = F.lit(((1 << 3 * level) - 1) << 3 * (15 - level)) if level else F.lit(0)
        centred = lambda c: c.bitwiseAND(used) == 0  # noqa: E731  all digits so far are 0
        deleted = lambda c: F.shiftright(c, 45).bitwiseAND(F.lit(127)).isin(*PENTAGONS) & centred(c)
        digits = lambda c: F.filter(F.sequence(F.lit(0), F.lit(6)), lambda d: (d != 1) | ~deleted(c))  # noqa: E731, B023
        out = F.flatten(F.transform(out, lambda c: F.transform(digits(c), lambda d: child(c, level, d))))  # noqa: B023
    return out


def to_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def hex_text(cell: int) -> str:
    """A cell's number as text, for documents."""
    return f"{cell:x}"


def from_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def half_up(x: Column) -> Column:
    """Rounded with halves upwards."""
    return F.floor(x + 0.5)


# Regions of the world in the order they are tried. Bounds (south, north, west, east) are
# exclusive, None is no bound; a row holds for points inside all of its bounds. North is inclusive in the
# regions of UP_TO.
REGIONS: tuple[tuple[str, float | None, float | None, float | None, float | None], ...] = (
    ("atlantic", 60, None, -60, -10),
    ("atlantic", 30, 45, -35, -15),
    ("atlantic", 10, 35, -30, -10),
    ("pacific", 45, None, None, -165),
    ("na-north", 50, None, -170, -50),
    ("na-west", 25, None, -170, -100),
    ("na-east", 25, None, -170, -50),
    ("central-america", 5, 25, -120, -55),
    ("sa-north", 0, None, -85, -30),
    ("sa-south", -60, None, -85, -30),
    ("pacific", -5, 5, -95, -85),
    ("europe", 35, None, -15, 60),
    ("middle-east", 10, 45, 30, 75),
    ("asia-east", 20, None, 100, 150),
    ("asia-south", 20, None, 60, 150),
    ("se-asia", -10, None, 60, 150),
    ("africa", -40, 40, -20, 55),
    ("oceania", None, -10, 110, 180),
    ("pacific", None, None, 150, None),
    ("pacific", None, None, None, -100),
    ("indian", -40, 30, 40, 120),
    ("sub-antarctic", None, -40, None, None),
)
UP_TO = frozenset(("central-america",))
ELSEWHERE = "remote"


def continent(lat: Column, lon: Column) -> Column:
    """The first region of REGIONS that holds the point."""
    out = F.lit(ELSEWHERE)
    for name, south, north, west, east in reversed(REGIONS):
        holds = F.lit(True)
        for x, low, high, closed in ((lat, south, north, name in UP_TO), (lon, west, east, False)):
            if low is not None:
                holds = holds & (x > low)
            if high is not None:
                holds = holds & ((x <= high) if closed else (x < high))
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


# The names of planned regions by their centre, in the order they are tried, bounds inclusive:
# (name, west, east, south, north); and parts of two of them by the longitude that they lie west of.
CENTRES = (
    ("na", -170, -50, 15, 75),
    ("europe", -20, 50, 35, 70),
    ("asia", 60, 150, -10, 55),
    ("sa", -85, -30, -60, 15),
    ("africa", 10, 55, -35, 35),
    ("oceania", 110, 180, -50, -10),
)
PARTS = {"na": (("west-coast", -110), ("midwest", -85), ("east-coast", None)), "europe": (("western", 10), ("central", 30), ("eastern", None))}


def centre_name(lat: Column, lon: Column) -> Column:
    """A readable name for a region by its centre: continent-part."""
    out = F.lit("unknown-main")
    for name, west, east, south, north in reversed(CENTRES):
        part = F.lit(f"{name}-main")
        for suffix, below in reversed(PARTS.get(name, ())):
            part = F.lit(f"{name}-{suffix}") if below is None else F.when(lon < below, F.lit(f"{name}-{suffix}")).otherwise(part)
        out = F.when(lon.between(west, east) & lat.between(south, north), part).otherwise(out)
    return out
