"""Trip and weather analytics as lazily evaluated Spark plans."""
