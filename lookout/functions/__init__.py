"""Column-level functions. Everything in here returns ``Column`` objects and stays JVM-side."""
