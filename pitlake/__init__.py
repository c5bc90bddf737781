"""Point-in-time analytics on Spark: sources, operators, functions, plans and streaming."""
