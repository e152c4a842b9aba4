"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""
