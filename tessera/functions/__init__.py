"""Scalar functions: positions, moves, evaluations, dates and codecs."""
