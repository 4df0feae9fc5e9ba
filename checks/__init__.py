"""Registered queries and the independent SQL each one is compared with."""
