"""Operators: the reference's per-key state, routing, windows and joins,
re-expressed as DataFrame compositions."""
