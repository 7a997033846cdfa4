"""Readers for landed files and writers for the three layers."""
