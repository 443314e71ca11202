"""Readers, writers and the staging area."""
