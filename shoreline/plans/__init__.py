"""Composed plans: the beach chain and the registered query catalog."""
