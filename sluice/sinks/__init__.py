"""Table sinks (O-28, O-29)."""

from sluice.sinks.tables import append_path, append_table, read_table

__all__ = ["append_path", "append_table", "read_table"]
