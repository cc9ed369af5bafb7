"""DataFrame operators: each takes and returns DataFrames, sets no session
configuration and triggers no job unless documented (skew checks)."""
