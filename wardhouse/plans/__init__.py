"""The warehouse itself: source columns, cleansing per table, dimensions, facts, forecasts, and the run by stages."""
