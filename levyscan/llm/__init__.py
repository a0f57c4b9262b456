"""Operators for building training data: each module holds one, `queries` applies them."""
