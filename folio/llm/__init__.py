"""Operations for preparing language-model training data.

One module per operator, ``queries.py`` with the registered ``opN_`` queries
and ``oracle.py`` with their DuckDB SQL.  Nothing outside this package
imports it, except the guarded lookup in ``__spark_entry__.py``.
"""
