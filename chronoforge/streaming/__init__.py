"""Streaming: the reference has no streaming entry point (every stage is a batch job), so no
streaming operator is built. Every operator here is a batch DataFrame transformation."""
