"""Data-quality checks, the runner and the layer gate."""
