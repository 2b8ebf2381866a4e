"""lakeloom: medallion data operators and training-data operators on Spark DataFrames."""
