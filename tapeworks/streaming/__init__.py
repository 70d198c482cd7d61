"""Incremental runs of the layers: process what is available, then stop."""
