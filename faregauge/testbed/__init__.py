"""Runs every operator on the generated tables, next to SQL that checks it."""
