"""Scalar functions as Column expressions: smart keys, calendar, geometry, temporal arrays."""
