"""Operators for preparing training data at scale, one module each; ``queries`` registers them."""
