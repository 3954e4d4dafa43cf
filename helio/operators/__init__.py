"""DataFrame-to-DataFrame transforms."""
