"""Structured Streaming: the live block feed kept folded into the daily facts."""
