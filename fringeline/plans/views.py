"""Radar catalogue and pixel tables as views on the driver's tables.

One text for both engines: Spark fills ``{table}`` with a DataFrame, the oracle with the table's name. Keys use integer and
date arithmetic only, so both agree.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_LON = "CAST(({k} * 37) % 3600 AS DOUBLE) / 10 - 180"
_LAT = "CAST(({k} * 53) % 1400 AS DOUBLE) / 10 - 70"


def _place(k: str) -> str:
    return f"{_LON.format(k=k)} AS lon, {_LAT.format(k=k)} AS lat"


#: A swath of 25 columns that grows by a row for every 50 parts.
_CELL = """CAST(floor(l_partkey / 50e0) AS BIGINT) AS "row", l_suppkey % 25 AS col"""


def _mean(c: str, unit: int, times: float = 1) -> str:
    """Mean of a column by a sum of integers in its unit, the same in any order."""
    return f"sum(CAST(round({c} * {unit}) AS BIGINT)) * {times}e0 / (count(*) * {unit}e0)"


VIEWS = {
    "bursts": f"""SELECT bid, iw, relorb, tanx, lon, lat, lon - 0.4 AS lon1, lon + 0.4 AS lon2, lat - 0.1 AS lat1, lat + 0.1 AS lat2
        FROM (SELECT p_partkey AS bid, CAST(p_size % 3 + 1 AS BIGINT) AS iw, p_partkey % 175 + 1 AS relorb,
              CAST((p_partkey * 97) % 59000 AS DOUBLE) / 10 AS tanx, {_place('p_partkey')} FROM {{part}})""",
    "official": f"""SELECT p_partkey + 500000 AS id, CAST(p_size % 3 + 1 AS BIGINT) AS iw,
              CASE WHEN p_partkey % 5 = 0 THEN (p_partkey + 1) % 175 + 1 ELSE p_partkey % 175 + 1 END AS relorb,
              CAST((p_partkey * 97) % 59000 + p_partkey % 21 AS DOUBLE) / 10 AS tanx, {_LON.format(k='p_partkey')} + CAST(p_partkey % 7 AS DOUBLE) / 20 AS lon,
              {_LAT.format(k='p_partkey')} AS lat FROM {{part}}""",
    "frames": f"""SELECT polyid, polyid_name, lon, lat, lon - 1.3 AS lon1, lon + 1.3 AS lon2, lat - 0.9 AS lat1, lat + 0.9 AS lat2
        FROM (SELECT s_suppkey AS polyid, concat(lpad(CAST(s_suppkey % 175 + 1 AS VARCHAR(10)), 3, '0'), CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'D' END, '_',
              lpad(CAST((s_suppkey * 53) % 18000 AS VARCHAR(10)), 5, '0'), '_', lpad(CAST(s_suppkey % 14 AS VARCHAR(10)), 2, '0'), '1312') AS polyid_name, {_place('s_suppkey')} FROM {{supplier}})""",
    "frame_bursts": "SELECT DISTINCT l_suppkey AS polyid, l_partkey AS bid FROM {lineitem} WHERE l_linenumber = 1",
    "files": """SELECT o_orderkey AS fid, CAST(o_orderdate AS DATE) AS acq_date, CASE o_orderstatus WHEN 'F' THEN 'VV' WHEN 'O' THEN 'HH' ELSE 'VH' END AS pol,
        o_orderkey % 2 AS sat, o_custkey % 8 AS series, CAST(floor(o_totalprice) AS BIGINT) AS size FROM {orders}""",
    "file_bursts": "SELECT l_orderkey AS fid, l_partkey AS bid, CAST(l_linenumber AS BIGINT) AS burst_no FROM {lineitem}",
    "epochs": "SELECT user_id AS frame, CAST(ts AS DATE) AS epoch, min(ts) AS acq_ts FROM {events} WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE)",
    "quakes": """SELECT event_id AS id, CAST(55 + event_id % 31 AS DOUBLE) / 10 AS magnitude, CAST(event_id % 60 AS DOUBLE) AS depth, ts,
        CAST((event_id * 41) % 3600 AS DOUBLE) / 10 - 180 AS lon, CAST((event_id * 59) % 1400 AS DOUBLE) / 10 - 70 AS lat FROM {events} WHERE event_type = 'error'""",
    "pixels": f"""SELECT {_CELL}, date_trunc('month', l_shipdate) AS epoch, {_mean('l_discount', 100, 10)} AS coh, {_mean('l_quantity', 1)} AS pha,
        {_mean('l_extendedprice', 100)} AS mag FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "look": f"""SELECT l_returnflag AS frame, {_CELL}, {_mean('l_extendedprice', 100, 0.001)} AS vel,
        CAST(CASE l_returnflag WHEN 'A' THEN 34 WHEN 'N' THEN 39 ELSE 44 END AS DOUBLE) AS inc, CAST(CASE l_returnflag WHEN 'A' THEN -10 WHEN 'N' THEN -170 ELSE -12 END AS DOUBLE) AS heading
        FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "jobs": "SELECT l_orderkey AS job, CAST(l_linenumber AS BIGINT) AS request, l_returnflag = 'R' AS failed FROM {lineitem}",
    "volcanoes": f"SELECT c_custkey AS volc_id, c_name AS name, c_mktsegment AS priority, {_place('c_custkey')} FROM {{customer}}",
}
#: Views on views: {name} of another view is filled with that view. Pairs reach two epochs on, but over none of the gaps that follow every
#: fifth and seventh epoch.
VIEWS["pairs"] = """SELECT a.frame, a.epoch AS epoch1, b.epoch AS epoch2 FROM (SELECT frame, epoch, row_number() OVER (PARTITION BY frame ORDER BY epoch) AS n FROM {epochs}) a
        JOIN (SELECT frame, epoch, row_number() OVER (PARTITION BY frame ORDER BY epoch) AS n FROM {epochs}) b ON a.frame = b.frame AND b.n > a.n AND b.n <= a.n + 2
        WHERE (a.n + a.frame) % 5 <> 0 AND (a.n + a.frame) % 7 <> 0 AND (b.n = a.n + 1 OR ((a.n + 1 + a.frame) % 5 <> 0 AND (a.n + 1 + a.frame) % 7 <> 0))"""


def _expanded(sql: str, quote: str) -> str:
    for name in re.findall(r"\{(\w+)\}", sql):
        if name in VIEWS:
            sql = sql.replace(f"{{{name}}}", f"({_expanded(VIEWS[name], quote)})")
    return sql.replace('"', quote)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame on the Parquet tables."""
    sql = _expanded(VIEWS[name], "`")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oracle(sql: str) -> str:
    """Oracle text: ``@view`` stands for a view's text, plain names for the driver's tables."""
    used = []
    for name in re.findall(r"@(\w+)", sql):
        if name not in used:
            used.append(name)
    ctes = ", ".join(f"v_{n} AS ({re.sub(r'{(\w+)}', r'\1', _expanded(VIEWS[n], '"'))})" for n in used)
    body = re.sub(r"@(\w+)", r"v_\1", sql).strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
