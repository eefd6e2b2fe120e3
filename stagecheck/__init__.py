"""Staged file migration and reconciliation as Spark jobs.

Files are mapped and cleaned into typed staging tables, staging tables are
mapped into final tables, and each stage ends with a hash reconciliation.
Every operator takes and returns DataFrames.
"""

from stagecheck.spec import Column, TableSpec, specs_from_config

__all__ = ["Column", "TableSpec", "specs_from_config"]
