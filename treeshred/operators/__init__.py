"""DataFrame operators over node, cell and row frames."""
