"""Compositions of operators into whole jobs and driver queries."""
