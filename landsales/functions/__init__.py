"""Column expressions: text cleaning, parsing, id synthesis, display formats."""
