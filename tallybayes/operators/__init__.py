"""DataFrame -> DataFrame operators (text, sampling, counting, models,
scoring, tabular features, metrics, validation)."""
