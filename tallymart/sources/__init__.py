"""Tables, raw-file ingest and the adapters that shape other star schemas into the bronze entities."""
