"""Learning operators on DataFrames: split, scaling, metrics, models."""
