"""Readers and writers: libsvm text, tables, model text, history."""
