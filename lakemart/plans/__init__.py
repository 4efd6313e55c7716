"""Composite plans: the bronze/silver/gold jobs and the registered queries."""
