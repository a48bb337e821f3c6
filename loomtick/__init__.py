"""loomtick: market-tape analytics as DataFrame, SQL and Structured Streaming transforms."""
