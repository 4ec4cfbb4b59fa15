"""Relational operators: tokenize, index build, topic statistics, scoring,
ranking and feedback. Each takes and returns DataFrames."""
