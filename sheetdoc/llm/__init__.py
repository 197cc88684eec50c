"""Operators of a training-data pipeline: one module per operator, each a ``DataFrame`` function
with its own general interface. ``queries`` holds the registered queries built on them. Nothing
else in the library imports this subpackage."""
