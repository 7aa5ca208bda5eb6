"""Shared physical strategies, projections of the test tables and the query catalog."""
