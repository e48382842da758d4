"""Readers and writers: tables, raw payload files, target lists, publication."""
