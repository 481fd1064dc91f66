"""Sources and sinks: landed files, topics, dimensions, keyed result tables."""
