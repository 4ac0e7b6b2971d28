"""The same jobs on a feed."""
