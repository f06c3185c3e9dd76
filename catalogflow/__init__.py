"""Product-catalog capture analytics on PySpark DataFrames."""
