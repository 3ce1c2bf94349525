"""Operators that prepare document collections for model training."""
