"""A document-table analytics engine on Spark: every operator is a function from DataFrames to a DataFrame."""
