"""Tax-revenue analytics as plain Spark functions: DataFrames in, DataFrame out."""
