"""Complete data jobs composed from the operators."""
