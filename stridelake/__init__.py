"""Activity and time-series analytics written as Spark DataFrame jobs."""
