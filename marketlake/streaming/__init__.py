"""Run-once Structured Streaming ingestion (availableNow) and streaming upsert."""
