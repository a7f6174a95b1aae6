"""Incremental loading: new files only, one month at a time."""
