"""Where bars and messages come from."""
