"""Column-level building blocks: ordered rules, seat codes, line patterns, display and masking expressions."""
