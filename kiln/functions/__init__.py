"""Column-level functions (pure expressions, whole-stage codegen friendly)."""
