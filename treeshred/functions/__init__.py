"""Column builders: names, typed values, text rendering, regex helpers."""
