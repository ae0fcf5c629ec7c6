"""The dataflow: raw rows, facts, marts, dashboard queries and the live view."""
