"""Bank-event analytics on Spark SQL and Structured Streaming."""
