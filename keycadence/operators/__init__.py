"""DataFrame-to-DataFrame operators; the same functions serve batch and stream."""
