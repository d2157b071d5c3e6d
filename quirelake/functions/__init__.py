"""Subpackage of quirelake."""
