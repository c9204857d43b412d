"""Distributed operators: ranking, rollups, calendar grids, splits, metrics, features, models, tuning, segments, tags."""
