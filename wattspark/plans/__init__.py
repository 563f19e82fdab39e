"""User-level plans: per-source processing, dataset builders, workflows."""
