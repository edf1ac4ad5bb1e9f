"""DataFrame -> DataFrame operators (joins, search, aggregation, sinks, quality, monitoring)."""
