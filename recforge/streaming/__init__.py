"""Structured Streaming forms of the rating aggregates (A1, A2).

The reference is batch only; these run the same label and product-statistics
aggregates incrementally over a stream of rating files, with Spark keeping
the per-key state.
"""
