"""Compositions of operators into jobs and registered queries."""
