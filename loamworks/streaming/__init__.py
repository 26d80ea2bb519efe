"""The pipelines as Structured Streaming queries."""
