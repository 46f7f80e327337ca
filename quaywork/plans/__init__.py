"""Domain views over the given tables and the registered queries."""
