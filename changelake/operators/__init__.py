"""Operators: registry queries, change events, gates, lineage, table updates and cursors."""
