"""Whole data products, composed from operators. All of them stay lazy."""
