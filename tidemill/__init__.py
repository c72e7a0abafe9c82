"""Distributed analytics operators for tables, text and vectors, written as DataFrame transformations."""
