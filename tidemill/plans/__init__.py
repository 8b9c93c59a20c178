"""Jobs composed of the operators, their deployment, and the queries over the given tables."""
