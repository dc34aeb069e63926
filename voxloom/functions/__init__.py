"""Column functions: native expressions first, Arrow UDFs where Spark has no builtin."""
