"""Column builders: no DataFrame is touched here, everything stays inside codegen."""
