"""Readers, writers and checks at the edge of a job."""
