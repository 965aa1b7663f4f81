"""Column-level building blocks: scalar expressions, frames and moments."""
