"""Composite plans: the preprocessing pipeline and the SQL analytics queries."""
