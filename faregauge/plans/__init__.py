"""Whole computations: the star schema, reports, audits and models."""
