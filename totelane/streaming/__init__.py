"""The scheduled run as a stream."""
