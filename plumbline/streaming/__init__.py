"""Change capture and debouncing as Structured Streaming jobs."""
