"""DataFrame operators shared by the plans: latest rows, version links, merges, joins, checks."""
