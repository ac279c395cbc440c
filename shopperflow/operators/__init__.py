"""One function per report: DataFrames and a snapshot date in, one DataFrame out."""
