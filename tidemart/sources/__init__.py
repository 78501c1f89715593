"""Topics, change records, dimension tables and summary sinks."""
