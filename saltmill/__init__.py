"""saltmill: data operators for tables and streams, written for Spark."""
