"""Relational operators over telemetry DataFrames."""
