"""DataFrame -> DataFrame operators (filters, sessions, indicators, features,
splits, backtest, metrics, execution, as-of joins, models)."""
