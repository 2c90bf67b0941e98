"""Structured Streaming: parsing, watermarked state, upserts."""
