"""DataFrame -> DataFrame operators (reshape, ranking, history, volatility, conform)."""
