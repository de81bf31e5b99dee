"""DataFrame operators: aggregation, emergence, languages, lead-lag, gates, reports."""
