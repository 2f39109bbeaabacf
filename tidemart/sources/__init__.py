"""Sources (S1-S6), sinks (K1-K6) and the test-table fixtures."""
