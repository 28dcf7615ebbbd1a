"""Jobs composed from the operators, the registered queries and their SQL oracles."""

from statforge.plans import clustering, jobs, tables

__all__ = ["clustering", "jobs", "tables"]
