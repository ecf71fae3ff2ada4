"""Streaming queries: one per hop and flow, each with its own checkpoint."""
