"""DataFrame-in, DataFrame-out steps of the warehouse."""
