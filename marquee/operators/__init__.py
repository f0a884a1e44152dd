"""DataFrame operators: joins, ranking, quality rules, latest-per-key, data shaping."""
