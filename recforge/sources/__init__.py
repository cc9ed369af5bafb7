"""Table sources and sinks: the fixture views over the driver's parquet tables
and the file formats the reference reads and writes (CSV samples, text
embeddings, persisted models)."""
