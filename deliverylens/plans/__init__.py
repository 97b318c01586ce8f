"""Ordered refreshes (batch and streaming) and the query catalogue."""
