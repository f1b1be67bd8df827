"""Registered queries over the driver's tables, each with its oracle SQL."""

from __future__ import annotations

from fringeline.plans import catalogue, ingest, networks, raster, scalar, spatial, stream

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _part in (scalar, catalogue, spatial, networks, raster, ingest, stream):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL
