"""Table-to-table operators; every one takes and returns DataFrames."""
