"""Readers, bronze layouts and table management."""
