"""All named queries of the engine and their DuckDB SQL."""

from __future__ import annotations

from kinweave.plans import population, publication, relational, resolution, steward, storage

QUERIES = {**relational.QUERIES, **resolution.QUERIES, **publication.QUERIES, **steward.QUERIES, **population.QUERIES, **storage.QUERIES}
ORACLE_SQL = {**relational.ORACLE_SQL, **resolution.ORACLE_SQL, **publication.ORACLE_SQL, **steward.ORACLE_SQL, **population.ORACLE_SQL, **storage.ORACLE_SQL}
