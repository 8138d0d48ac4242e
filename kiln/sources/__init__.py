"""Scans and sinks: driver tables, CSV/JSON/TSV files, exports."""

from kiln.sources.tables import TABLES, load

__all__ = ["TABLES", "load"]
