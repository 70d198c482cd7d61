"""Where results go. Every batch sink can run twice and leave the same table."""
