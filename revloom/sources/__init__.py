"""Readers, writers and catalog lookups. Jobs themselves do no I/O."""
