"""Spark-native analysis and forecasting of price-bar time series."""
