"""Column functions: keys, presence, sentinels, stored text and Connect records."""
