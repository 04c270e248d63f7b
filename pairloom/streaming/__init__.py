"""The stateless text chain on a stream."""
