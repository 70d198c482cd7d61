"""Where data comes from. Credentials and addresses always come from the caller."""
