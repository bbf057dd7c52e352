"""Column expressions and small DataFrame helpers shared by every operator."""
