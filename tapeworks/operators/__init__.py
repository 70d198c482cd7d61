"""DataFrame steps that the plans compose. Nothing here reads, writes or acts."""
