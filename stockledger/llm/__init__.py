"""Operators for the texts of a training corpus. Nothing outside this package imports it."""
