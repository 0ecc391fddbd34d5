"""Table schemas, the registry catalog, and batch and streaming readers."""
