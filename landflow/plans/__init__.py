"""Compositions of operators: cleaning stage, entity load, regional load, publishing."""
