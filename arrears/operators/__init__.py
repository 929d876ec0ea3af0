"""Steps from the source tables to segment totals."""
