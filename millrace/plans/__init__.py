"""Ready-made programs: broker records in, result rows out."""
