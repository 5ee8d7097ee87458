"""Structured Streaming: live metrics, alert lifecycle, landing."""
