"""Operators for preparing language-model training text, and their queries.

Nothing outside this subpackage imports it. Each module holds one operator with
its general interface; :mod:`statforge.llm.queries` registers the thin queries
over the test tables and :mod:`statforge.llm.oracles` their DuckDB SQL.
"""
