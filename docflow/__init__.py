"""docflow: typed, reviewed records from tables of document text, on Spark."""
