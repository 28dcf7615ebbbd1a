"""Relational operators over positional text records."""

from statforge.operators import aggregate, kmeans, order, predicates, project

__all__ = ["aggregate", "kmeans", "order", "predicates", "project"]
