"""Column expressions (JVM side) and NumPy kernels (inside Arrow batches)."""
