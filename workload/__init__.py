"""Check queries over the generated tables, with their SQL counterparts."""
