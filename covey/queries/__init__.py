"""Registered queries of the observation engine and the SQL that checks them.

Each query applies operators of the library to the driver's tables, which stand in for observations:
lineitem rows are records of a taxon (part) on a checklist (order) in a cell (supplier, in its nation, in
its region), see views.py.
"""

from .registry import QUERIES, SQL
from . import comparing, frequencies, grid, ingest, kits, lookups, planning, taxonomy  # noqa: F401  they register their queries

FLAGSHIP = "freq_monthly"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
