"""Multi-resolution time-series analytics as pure DataFrame functions."""
