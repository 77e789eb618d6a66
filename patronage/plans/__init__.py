"""The seven extracts and the query registry."""
