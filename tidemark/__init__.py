"""tidemark: warehouse data-pipeline operators as plain Spark DataFrame functions."""
