"""Reading topics, files and database tables."""
