"""Column expressions (all built-in Spark functions, JVM side)."""

from sluice.functions.dates import compact_day, default_window, mdy, parse_mdy, previous_day
from sluice.functions.names import fill_template, landing_name, table_name, xml_text

__all__ = ["compact_day", "default_window", "mdy", "parse_mdy", "previous_day",
           "fill_template", "landing_name", "table_name", "xml_text"]
