"""Column expressions for the SQL dialect semantics the pipeline depends on."""
