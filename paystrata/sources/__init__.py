"""Where rows come from and go to: lake tables, topics, keyed logs, lookups."""
