"""Readers, writers, declared schemas and shared storage."""
