"""Sales and delivery analytics over tables and nested documents, on Spark."""
