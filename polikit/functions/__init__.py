"""Column-expression builders: pure functions returning ``Column`` (JVM-side, codegen-friendly)."""
