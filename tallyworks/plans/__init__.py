"""Operators composed into whole jobs and reports."""
