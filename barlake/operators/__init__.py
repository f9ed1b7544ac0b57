"""Reusable DataFrame operators: dedupe, per-ticker series, joins, top-k, reshape, unions."""
