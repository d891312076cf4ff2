"""newsloom: clean, grow, embed and search a large article corpus with Spark."""
