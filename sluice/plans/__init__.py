"""Feed catalog and request planning (which payloads to ask for)."""
