"""sensorflow: keyed event analytics on Spark (batch and Structured Streaming)."""
