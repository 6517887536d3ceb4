"""Operators bound to tables as registered queries, with their SQL twins."""

from terrakern.plans import files, items, lakehouse, records, relational, scalars, streams

QUERIES = scalars.QUERIES | relational.QUERIES | lakehouse.QUERIES | records.QUERIES | files.QUERIES | items.QUERIES | streams.QUERIES
ORACLE_SQL = scalars.SQL | relational.SQL | lakehouse.SQL | records.SQL | files.SQL | items.SQL | streams.SQL
