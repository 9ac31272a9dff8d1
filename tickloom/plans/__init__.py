"""Models, quality checks and the refresh that writes them."""
