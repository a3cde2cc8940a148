"""Table-to-table operators (lazy DataFrame transformations)."""
