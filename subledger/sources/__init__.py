"""Sources: raw-file ingest (bronze) and adapters over the shared test tables."""
