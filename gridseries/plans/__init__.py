"""User-level queries and jobs composed from the operators."""
