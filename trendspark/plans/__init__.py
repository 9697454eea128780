"""Whole jobs composed of the operators, and the input tables of the registered queries."""
