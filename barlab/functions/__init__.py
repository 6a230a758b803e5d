"""Column builders without any state."""
