"""DataFrame-level operators."""
