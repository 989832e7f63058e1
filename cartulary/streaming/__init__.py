"""File arrivals as a Structured Streaming source."""
