"""Operators on nested records: normalise, validate, repair, vary, audit and score them."""
