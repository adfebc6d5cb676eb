"""Column-level building blocks. Each returns a Column or renames columns; none is a Python UDF."""
