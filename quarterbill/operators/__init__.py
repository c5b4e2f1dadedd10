"""DataFrame operators: replay of the form log, membership, prices, checks."""
