"""Column-level helpers (pure Spark SQL expressions, codegen-friendly)."""
