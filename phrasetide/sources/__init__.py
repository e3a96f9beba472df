"""Where posts, topics and stored tables are read from and written to."""
