"""Building blocks shared by the extracts (one function per block)."""
