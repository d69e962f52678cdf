"""Column expressions: text clean-up, guarded casts, calendar attributes."""
