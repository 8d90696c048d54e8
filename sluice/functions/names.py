"""Names and URLs built from columns (O-08, O-25, O-26)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.dates import as_col, as_of_col, compact_day


def table_name(endpoint) -> Column:
    """O-25: drop '-' and '.' from a feed id ('listings-3.0' -> 'listings30')."""
    return F.translate(as_col(endpoint), "-.", "")


def landing_name(endpoint, source_id, as_of=None) -> Column:
    """O-26: '<endpoint>.<source id>.<MMddyyyy>.xml' for a landed payload.

    The source id is part of the name so two ids of one feed never share a
    landing file.
    """
    return F.concat_ws(".", as_col(endpoint), as_col(source_id).cast("string"),
                       compact_day(as_of_col(as_of)), F.lit("xml"))


def fill_template(template, slots: dict[int, Column]) -> Column:
    """O-08: fill positional ``{n}`` slots of a template column.

    Slots without a value stay as they are, and values for slots that the
    template does not contain are ignored, as with ``str.format`` over extra
    arguments.
    """
    out = as_col(template)
    for n, value in sorted(slots.items()):
        out = F.replace(out, F.lit("{%d}" % n), F.coalesce(as_col(value).cast("string"), F.lit("")))
    return out


def xml_text(c) -> Column:
    """Text escaped for an XML element body ('&', '<', '>')."""
    out = as_col(c) if not isinstance(c, str) else F.col(c)
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out
