"""Market-data analytics on Spark: DataFrame operators, sources, sinks and streams."""
