"""Scalar functions: text normal forms, ordered taxonomies, label parts, dates."""
