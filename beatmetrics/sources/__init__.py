"""CSV readers, writers and the views derived from the TPC-H-like tables."""
