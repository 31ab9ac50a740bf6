"""Column expressions of the key, the features, the flags and the score."""
