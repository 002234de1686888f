"""Column functions and partition-safe scans shared by the operators."""
