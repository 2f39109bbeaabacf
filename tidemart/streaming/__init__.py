"""Structured Streaming forms of the jobs: keyed state (applyInPandasWithState)
for the per-device / per-user operators, watermarked windows for metrics."""
