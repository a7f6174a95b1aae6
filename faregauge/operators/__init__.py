"""Operators: ``f(frame, **parameters) -> DataFrame``, lazily evaluated."""
