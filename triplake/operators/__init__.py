"""DataFrame -> DataFrame operators, one module per lake layer."""
