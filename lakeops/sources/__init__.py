"""Readers and writers of the lake's layers."""
