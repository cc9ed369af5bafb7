"""What the driver's entry module registers from this subpackage."""

import corpus_pipeline
from recforge.llm import queries, sql

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLE: dict[str, str] = dict(sql.ORACLE)
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
