"""Mart steps: compositions of the generic operators, one function per step."""
