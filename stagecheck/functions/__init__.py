"""Column functions: hashes, money, times, text and names."""
