"""Jobs: feeds with a position, file ingest, history runs."""
