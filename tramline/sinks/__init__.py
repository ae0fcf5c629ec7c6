"""Writers: partition replacement, latest-wins state, recent-snapshot lines."""
