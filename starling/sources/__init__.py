"""Sources and sinks: test-table mapping, CSV feed, enriched CSV file, tables."""
