"""Operators on document texts: packing, mixing, shared spans."""
