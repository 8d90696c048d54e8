"""Data operators: XML and JSON payload parsing, filters, caps, set ops."""
