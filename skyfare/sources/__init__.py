"""Readers and writers.  Everything returns a lazy DataFrame; nothing is collected."""
