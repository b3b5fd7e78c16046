"""The event-file source: format, schema, planning, decoding, and a writer."""
