"""Readers (S1-S10), sinks (S11-S14) and the driver-table loader."""

from sparkfolio.sources.tables import TABLES, load  # noqa: F401
