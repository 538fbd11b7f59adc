"""Code-naming datasets and their evaluation, written as Spark DataFrame operators."""
