"""Relational operators: snapshot state, shaping, joins/filters/aggregates, windows."""
