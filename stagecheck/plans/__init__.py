"""Whole jobs: stage loads, reconciliations, and the tables they are declared for."""
