"""DataFrame operators and ML stages."""
