"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; ``__spark_entry__``
adds its queries only when it can be imported.
"""
