"""DataFrame operators. Keys, versions and measures are always parameters."""
