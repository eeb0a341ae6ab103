"""Scalar column functions, all built from JVM expressions unless the docstring says otherwise."""
