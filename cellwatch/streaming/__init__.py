"""Structured Streaming form of the batch path (not a reference capability: an extension)."""
