"""DataFrame to DataFrame operators and sinks."""
