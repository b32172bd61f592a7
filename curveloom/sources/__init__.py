"""Readers, schemas and the build-or-read sink."""
