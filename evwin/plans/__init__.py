"""Plans: the model layer (M01-M14), serving queries (D01-D24), data-quality
checks (Q01-Q04) and the query catalog used by ``__spark_entry__``."""
