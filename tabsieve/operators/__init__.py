"""DataFrame operators: diagnose, clean, impute, correlate, split, encode, score."""
