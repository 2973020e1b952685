"""DataFrame to DataFrame operators, one module per warehouse layer."""
