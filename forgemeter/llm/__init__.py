"""Operators for preparing training data: ten operators, one module each, and their queries."""
