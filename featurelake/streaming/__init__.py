"""Structured Streaming operators: envelopes, decoding, upserts, scoring."""
