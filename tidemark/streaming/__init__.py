"""Change-event parsing and Structured Streaming jobs."""
