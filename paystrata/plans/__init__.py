"""Table jobs in layer order, and the registered queries."""
