"""Readers and writers: tables, file listings, policy documents, results."""
