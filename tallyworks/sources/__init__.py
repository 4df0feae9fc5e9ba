"""Readers that yield transactions, customers and products."""
