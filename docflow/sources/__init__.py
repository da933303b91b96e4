"""Tables the engine reads and appends to."""
