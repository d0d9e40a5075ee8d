"""Column expressions; all of them run inside whole-stage codegen."""
