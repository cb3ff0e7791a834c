"""DataFrame operators: joins, lookups, splits, metrics, gates, models."""
