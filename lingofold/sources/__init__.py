"""Readers for request files, corpora and images, and the result writer."""
