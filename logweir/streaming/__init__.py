"""The collect job as a Structured Streaming query."""
