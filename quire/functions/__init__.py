"""Column-level building blocks: text cleaning/tokenizing and weights."""
