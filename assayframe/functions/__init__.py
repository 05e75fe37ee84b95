"""Pure functions from values to Spark Columns, and the fixed values they use."""
