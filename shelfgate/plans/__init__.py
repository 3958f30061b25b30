"""Plans: ingest and the registered queries with their SQL oracle."""
