"""Fixed-sensor time series on Spark: cleaning, splits, forecasts and spatial grids."""
