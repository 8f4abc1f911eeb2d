"""Column builders and driver-side date arithmetic."""
