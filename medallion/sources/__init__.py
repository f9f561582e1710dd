"""Readers and writers: files, relational queries, documents and message topics."""
