"""The ingest as a stream of landing files."""
