"""Transformations from DataFrame to DataFrame; none of them runs an action."""
