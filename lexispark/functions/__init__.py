"""Column expressions: text clean-up, stop-words, n-grams and in-row term counts."""
