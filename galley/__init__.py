"""galley: document-feed analytics on PySpark DataFrames."""
