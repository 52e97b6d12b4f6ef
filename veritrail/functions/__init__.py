"""Column-level functions: cleaning, dates and grading."""
