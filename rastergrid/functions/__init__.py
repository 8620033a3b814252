"""Column expressions: grid, row keys, packed dates, texts and pixel decoding."""
