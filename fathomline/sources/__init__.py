"""Readers, writers, file ingest, configuration, SQL files."""
