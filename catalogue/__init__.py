"""Driver queries and their SQL counterparts."""
