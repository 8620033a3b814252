"""Sources and sinks: tile cells, tile files, key-value cells, catalog tables, orders, results."""
