"""Plan building blocks shared by operators: shared tables, graph contraction."""
