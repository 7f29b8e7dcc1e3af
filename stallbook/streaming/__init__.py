"""The daily feed and deduplication as Structured Streaming jobs."""
