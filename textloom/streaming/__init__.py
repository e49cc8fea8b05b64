"""The ingestion as a stream of files, and running rates of a stream of events."""
