"""The gate and bars as Structured Streaming jobs."""
