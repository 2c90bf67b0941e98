"""Readers with explicit schemas: files, file increments, topics, databases, literals."""
