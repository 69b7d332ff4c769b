"""Readers and writers. Every reader is given an explicit schema."""
