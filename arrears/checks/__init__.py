"""The reports on the driver's test tables, with the same in SQL."""
