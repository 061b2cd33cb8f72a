"""Column expressions over rows and partition keys."""
