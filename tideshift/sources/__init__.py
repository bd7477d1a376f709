"""Readers and writers: landed payloads, the measurement lake, feature sets, logs, synthetic series."""
