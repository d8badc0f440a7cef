"""Readers and writers. Locations and connection settings come from the caller."""
