"""Column-level building blocks: rounding, clocks, validity, weather, quantiles."""
