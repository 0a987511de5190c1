"""Column-level building blocks: exact order statistics, scalar math, dates."""
