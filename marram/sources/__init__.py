"""Readers: from files to the tables the operators take."""
