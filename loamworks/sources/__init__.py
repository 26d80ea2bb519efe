"""Where pages come from."""
