"""All queries and their DuckDB SQL."""

from signalloom.plans import q_mining, q_scores, q_sources, q_text

QUERIES, ORACLE = {}, {}
for module in (q_text, q_scores, q_sources, q_mining):
    QUERIES |= module.QUERIES
    ORACLE |= module.ORACLE
