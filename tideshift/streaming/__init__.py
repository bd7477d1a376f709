"""Streams: the batch operators applied to arriving rows."""
