"""Column-level helpers. Everything here returns a ``Column`` built from JVM-side functions."""
