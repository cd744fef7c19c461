"""Sources: driver tables, derived bronze fixtures, seeds, file sources."""
