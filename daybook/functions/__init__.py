"""Column expressions: cleaning, parsing, money arithmetic and rule chains."""
