"""Sources: in-memory rows, text lines (batch or stream), CSV tables, topics,
and the random-walk sensor generator."""

from eventlens.sources.files import from_rows, read_lines, register_csv
from eventlens.sources.generator import sensor_walk

__all__ = ["from_rows", "read_lines", "register_csv", "sensor_walk"]
