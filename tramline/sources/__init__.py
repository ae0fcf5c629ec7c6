"""Readers: realtime snapshot files, schedule folders, recent-snapshot lines."""
