"""Training-data operators: ten operators and the queries that apply them.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where it is present.
"""
