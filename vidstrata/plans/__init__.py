"""Stored tables, gold reports and the daily run built from the operators."""
