"""Column-level building blocks: field access, text coercion, ids, time."""
