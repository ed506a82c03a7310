"""Distributed building blocks and the warehouse composition."""
