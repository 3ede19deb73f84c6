"""Bronze / silver / gold operators for PySpark: every operator maps DataFrames to a DataFrame."""
