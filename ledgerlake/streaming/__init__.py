"""Change-stream, late-data, audit and recovery operators."""
