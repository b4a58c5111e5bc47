"""Column expressions; everything here stays in whole-stage codegen."""
