"""Operators over training documents. Nothing else in this library imports this subpackage."""
