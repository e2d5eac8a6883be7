"""DataFrame operators over entities, recordings and signal samples."""
