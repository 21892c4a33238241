"""Structured Streaming forms of the ad-click statistics."""
