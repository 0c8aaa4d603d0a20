"""At-least-once event ingest with Structured Streaming."""
