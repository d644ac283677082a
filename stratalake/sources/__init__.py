"""Decoders from published documents and seed files to long bronze records."""
