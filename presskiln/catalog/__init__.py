"""Queries over the test tables, each with the SQL that must give the same rows.

A module holds the queries of one area: ``QUERIES`` maps a key to a function of a session
and a folder, ``ORACLES`` maps the same keys to DuckDB SQL on the same tables.
"""

from presskiln.catalog import jobs, pages, pipelines, registry, runs, stored, urls

AREAS = (pages, urls, registry, jobs, runs, stored, pipelines)
