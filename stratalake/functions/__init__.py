"""Column functions: Column in, Column out, all inside generated code."""
