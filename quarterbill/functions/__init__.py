"""Column functions, the price policy and the period arithmetic."""
