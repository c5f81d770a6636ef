"""Market analytics on Spark: candles, indicators, signals, news impact,
research features, forecast frames and serving views."""
