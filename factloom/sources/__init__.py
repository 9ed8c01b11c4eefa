"""Readers, tables and scratch storage."""
