"""Readers, staging and the versioned snapshot store."""
