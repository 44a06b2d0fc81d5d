"""Column helpers, distributions and small per-series kernels."""
