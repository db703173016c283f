"""DataFrame and Structured Streaming operators for running a data lake."""
