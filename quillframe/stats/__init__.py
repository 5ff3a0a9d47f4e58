"""Empirical distributions and resampling inference."""
