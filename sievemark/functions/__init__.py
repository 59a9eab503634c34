"""Column helpers with fixed rounding, casting and calendar semantics."""
