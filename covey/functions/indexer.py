"""Cells of places: an interface, the hexagon index, and square cells where a grid of degrees will do."""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from . import geo, hexagon


class CellIndexer(Protocol):
    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        """The cell of a place, as a long; null for places that aren't on Earth."""

    def centre(self, cell: Column, resolution: int) -> tuple[Column, Column]:
        """Latitude and longitude of a cell's centre."""


class SquareGrid:
    """Squares of 180 / 2 ** (resolution + 3) degrees, in expressions only. A cell at one resolution lies in one at each coarser."""

    def _step(self, resolution: int) -> float:
        return 180.0 / 2 ** (resolution + 3)

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        n = 2 ** (resolution + 3)
        row = F.least(F.floor((lat + 90) / self._step(resolution)), F.lit(n - 1)).cast("long")
        column = F.least(F.floor((lon + 180) / self._step(resolution)), F.lit(2 * n - 1)).cast("long")
        return F.when(lat.between(-90, 90) & lon.between(-180, 180), row * F.lit(2 * n) + column)

    def parent(self, cell: Column, resolution: int, coarser: int) -> Column:
        width, by = 2 ** (resolution + 4), 2 ** (resolution - coarser)
        row, column = F.floor(cell / width).cast("long"), F.pmod(cell, F.lit(width))
        return F.floor(row / by).cast("long") * F.lit(width // by) + F.floor(column / by).cast("long")

    def centre(self, cell: Column, resolution: int) -> tuple[Column, Column]:
        width, step = 2 ** (resolution + 4), self._step(resolution)
        row, column = F.floor(cell / width), F.pmod(cell, F.lit(width))
        return (row + 0.5) * step - 90, (column + 0.5) * step - 180


class HexagonIndex:
    """The hierarchical hexagon index (see hexagon), over Arrow batches. A cell's number tells its resolution."""

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        @F.pandas_udf("long")
        def index(lat: pd.Series, lon: pd.Series) -> pd.Series:
            good = (lat.between(-90, 90) & lon.between(-180, 180)).to_numpy()
            out = pd.Series(pd.NA, index=lat.index, dtype="Int64")
            out[good] = hexagon.cell_of(lat[good].to_numpy(), lon[good].to_numpy(), resolution)
            return out

        return index(lat.cast("double"), lon.cast("double"))

    def parent(self, cell: Column, resolution: int, coarser: int) -> Column:
        return geo.parent(cell, coarser)

    def centre(self, cell: Column, resolution: int | None = None) -> tuple[Column, Column]:
        @F.pandas_udf("lat double, lon double")
        def place(cell: pd.Series) -> pd.DataFrame:
            out = np.full((len(cell), 2), np.nan)
            known = cell.notna().to_numpy()
            out[known] = hexagon.centre_of(cell[known].astype("int64"))
            return pd.DataFrame(out, columns=["lat", "lon"])

        found = place(cell)
        return F.nanvl(found["lat"], F.lit(None)), F.nanvl(found["lon"], F.lit(None))

    def boundary(self, cell: Column) -> Column:
        """Corners of a cell, counter-clockwise; null where it crosses the antimeridian, and for no cell."""

        @F.pandas_udf("array<struct<lat:double,lon:double>>")
        def corners(cell: pd.Series) -> pd.Series:
            known = cell.notna().to_numpy()
            rings = iter(hexagon.corners_of(cell[known].astype("int64")))
            out = []
            for k in known:
                ring = next(rings) if k else None
                shown = ring is not None and np.ptp(ring[:, 1]) <= 180
                out.append(list(dict.fromkeys((float(a), float(b)) for a, b in ring.round(12))) if shown else None)
            return pd.Series([None if r is None else [{"lat": a, "lon": b} for a, b in r] for r in out])

        return corners(cell)

    def ring(self, cell: Column, k: int) -> Column:
        """Cells at a grid distance up to k, in order; null for no cell."""

        @F.pandas_udf("array<long>")
        def disk(cell: pd.Series) -> pd.Series:
            known = cell.notna().to_numpy()
            owner, found = hexagon.disk(cell[known].astype("int64"), k)
            parts = iter(np.split(found, np.flatnonzero(np.diff(owner)) + 1))
            return pd.Series([next(parts) if x else None for x in known])

        return disk(cell)


def indexer() -> CellIndexer:
    """What packs are made with."""
    return HexagonIndex()
