"""Readers, writers, the shared work folder and the run log."""
