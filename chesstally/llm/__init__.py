"""Operators for preparing text training data at scale.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` registers its queries
when it is present.
"""
