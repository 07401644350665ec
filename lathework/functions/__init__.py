"""Column-level building blocks: naming, hashing, scalar and metric expressions."""
