"""Inputs for the queries, made from the given tables. Each text is SQL that Spark and DuckDB read alike, but for tile_pixels."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "geo_points": r"""
SELECT o_orderkey AS point_id, CAST(o_orderkey % 19 AS INT) AS z,
       CAST((o_orderkey * 7919) % 170000 AS DOUBLE) / 1000 - 85 AS lat,
       CAST((o_orderkey * 104729) % 360000 AS DOUBLE) / 1000 - 180 AS lng,
       o_totalprice AS true_scale
FROM orders
""",
    "chart_boxes": r"""
SELECT p_partkey AS chart_id,
       concat('/charts/', lower(p_type), '/', CAST(10000 + p_partkey AS STRING), '_1.KAP') AS path,
       CASE WHEN p_partkey % 50 = 0 THEN concat('Cover for Chart ', p_name) ELSE p_name END AS name,
       CASE p_partkey % 6 WHEN 0 THEN 'noaa' WHEN 1 THEN 'faa' WHEN 2 THEN 'brazil' WHEN 3 THEN 'linz'
                          WHEN 4 THEN 'ukho' ELSE 'wavey-lines' END AS provider,
       CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE 2000 + ((p_partkey * 37) % 5000) * 100 END AS scale,
       CAST(w AS DOUBLE) / 1000 - 180 AS west,
       CAST(s AS DOUBLE) / 1000 - 70 AS south,
       CASE WHEN w + 50 + p_size * 30 > 360000 THEN CAST(w + 50 + p_size * 30 - 360000 AS DOUBLE) / 1000 - 180
            ELSE CAST(w + 50 + p_size * 30 AS DOUBLE) / 1000 - 180 END AS east,
       CAST(s + 50 + p_size * 20 AS DOUBLE) / 1000 - 70 AS north
FROM (SELECT *, CASE WHEN p_partkey % 100 = 7 THEN 359990 ELSE (p_partkey * 104729) % 360000 END AS w,
             (p_partkey * 7919) % 140000 AS s FROM part) p
""",
    "tile_layers": r"""
SELECT l_suppkey AS chart_id, CAST(10 + l_linenumber % 3 AS INT) AS z,
       300 + l_partkey % 64 AS x, 500 + l_orderkey % 64 AS y,
       MAX(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 ELSE -1 END) AS transp,
       CAST(MAX(l_quantity) * 100 AS BIGINT) AS n_bytes
FROM lineitem GROUP BY 1, 2, 3, 4
""",
    "raster_meta": r"""
SELECT s_suppkey AS chart_id, CAST(512 + (s_suppkey * 37) % 2048 AS INT) AS xsize, CAST(512 + (s_suppkey * 53) % 2048 AS INT) AS ysize,
       CAST((s_suppkey * 104729) % 30000000 - 15000000 AS DOUBLE) AS gt0, CAST(4 + s_nationkey AS DOUBLE) AS gt1, CAST(0 AS DOUBLE) AS gt2,
       CAST((s_suppkey * 700001) % 20000000 - 10000000 AS DOUBLE) AS gt3, CAST(0 AS DOUBLE) AS gt4, CAST(-4 - s_nationkey AS DOUBLE) AS gt5,
       127 AS dpi
FROM supplier
""",
    "chart_headers": r"""
SELECT p_partkey AS chart_id, concat(
         '!', CAST(p_partkey AS STRING), chr(10),
         'BSB/NA=', p_name, ' O''', p_brand, ',NU=', CAST(p_partkey AS STRING), chr(10),
         'KNP/SC=', CAST(2000 + (p_partkey * 37) % 50000 AS STRING), ',GD=WGS84,PR=MERCATOR,PP=0', chr(10),
         CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('    PI=0,UN=', p_brand, ',SD=MLLW', chr(10)) END,
         'CED/SE=1,RE=1,ED=0', CAST(1 + p_partkey % 9 AS STRING), '/15/2', CAST(100 + p_partkey % 900 AS STRING), chr(10),
         'REF/1,10,10,', CAST(p_size AS STRING), ',0', chr(10),
         'REF/2,10,10,', CAST(p_size + p_partkey % 2 AS STRING), ',0', chr(10),
         'PLY/1,', CAST(p_size AS STRING), '.25,-', CAST(p_size AS STRING), '.5', chr(10),
         'PLY/2,', CAST(p_size + 1 AS STRING), '.25,-', CAST(p_size AS STRING), '.5', chr(10),
         'PLY/3,', CAST(p_size + 1 AS STRING), '.25,', CAST(p_partkey % 20 AS STRING), '.5', chr(10)) AS header
FROM part
""",
    "chart_files": r"""
SELECT p_partkey AS file_id, concat('/charts/ukho/', CASE WHEN p_partkey % 5 = 0 THEN 'my area & more/' ELSE 'geotiff/' END,
         lpad(CAST(p_partkey % 700 AS STRING), 4, '0'), CASE p_partkey % 4 WHEN 0 THEN 'A' ELSE '' END, '-', CAST(p_size % 3 AS STRING),
         CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_W' ELSE '_UD' END,
         CASE p_partkey % 11 WHEN 0 THEN '.KAP' WHEN 1 THEN '.txt' ELSE '.tif' END) AS path
FROM part
""",
    "sheet_charts": r"""
SELECT p_partkey AS row_no, CASE WHEN p_partkey % 13 = 0 THEN 'NZ' ELSE '---' END AS prefix, p_partkey % 700 AS number,
       CASE p_partkey % 4 WHEN 0 THEN 'A' ELSE '-' END AS suffix, concat(p_name, '  O''', p_brand) AS title,
       1000 + p_size * 500 AS scale, p_partkey % 8 AS depth_code
FROM part
""",
    "sheet_panels": r"""
SELECT p_partkey AS row_no, CASE WHEN p_partkey % 17 = 0 THEN 'AUS' ELSE '---' END AS prefix, p_partkey % 700 AS number,
       CASE p_partkey % 4 WHEN 0 THEN 'A' ELSE '-' END AS suffix, p_size % 3 AS panel, concat(p_type, ' ', p_name) AS title,
       500 + p_size * 100 AS scale, p_size % 8 AS depth_code
FROM part
""",
    "sheet_depth_codes": r"""
SELECT r_regionkey AS code, concat(lower(r_name), '/feet') AS unit FROM region
""",
    "sheet_editions": r"""
SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 19 = 0 THEN 'NZ' ELSE '---' END AS prefix, o_custkey % 700 AS number,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 30000 + o_orderkey % 14000 END AS serial
FROM orders
""",
    "sheet_vertices": r"""
SELECT l_orderkey * 10 + l_linenumber AS row_no, l_partkey % 700 AS number, CASE l_partkey % 4 WHEN 0 THEN 'A' ELSE '-' END AS suffix,
       l_linenumber % 3 AS panel,
       concat(CASE WHEN l_orderkey % 2 = 0 THEN '-' ELSE '' END, CASE WHEN l_suppkey % 80 = 0 THEN '' ELSE CAST(l_suppkey % 80 AS STRING) END,
              lpad(CAST(l_partkey % 60 AS STRING), 2, '0'), '.5') AS lat_cell,
       concat(CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE '' END, CASE WHEN l_orderkey % 170 = 0 THEN '' ELSE CAST(l_orderkey % 170 AS STRING) END,
              lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), '.25') AS lng_cell
FROM lineitem
""",
    "stage_log": r"""
SELECT event_id AS line_no, CASE WHEN event_id % 29 = 0 THEN 'broken line'
       ELSE concat('REGION_', CAST(user_id % 34 AS STRING), ':::', CASE user_id % 3 WHEN 0 THEN 'MX_REGION' WHEN 1 THEN 'MB_CHARTS' ELSE 'MB_REGION' END,
         ':::', CASE event_type WHEN 'click' THEN 'checkpoint_catalog' WHEN 'view' THEN 'CHECKPOINT_MERGE' WHEN 'error' THEN 'NO_SUCH_STAGE'
                ELSE 'CHECKPOINT_ARCHIVE' END) END AS line
FROM events
""",
    "manifest_old": r"""
SELECT concat('REGION_', CAST(s_suppkey AS STRING)) AS region, s_suppkey * 1000 AS size_bytes, 1600000000 + s_suppkey * 86400 AS epoch
FROM supplier WHERE s_suppkey % 3 <> 2
""",
    "burn_names": r"""
SELECT c_custkey AS id, concat(lpad(CAST(c_custkey % 97 AS STRING), 4, '0'), '-0:', lower(c_mktsegment), ':', CAST(c_custkey % 100 AS STRING), ':',
         CAST((c_custkey * 31) % 2000 AS STRING), ':', CAST((c_custkey * 17) % 2000 AS STRING), '.png') AS file
FROM customer
""",
    "product_texts": r"""
SELECT p_partkey AS node_id, concat('<EX_Extent><description><gco:CharacterString>title: ', p_name, ', file name: ',
         CAST(10000 + p_partkey % 1500 AS STRING), '_', CAST(1 + p_partkey % 2 AS STRING), '.KAP</gco:CharacterString></description></EX_Extent>') AS xml
FROM part
""",
    "archive_files": r"""
SELECT p_partkey AS id, concat(CASE WHEN p_partkey % 2 = 0 THEN 'TS_2020-01-01_T_00_00_' ELSE '' END, 'REGION_', CAST(p_size AS STRING),
         CASE p_partkey % 3 WHEN 0 THEN '.gemf' WHEN 1 THEN '.zdat' ELSE '.mbtiles' END) AS file,
       concat(replace(p_name, ' ', '_'), '_', CAST(p_partkey % 90 AS STRING), '.zip') AS numbered_file,
       1500000000 + p_partkey * 86399 AS epoch, concat('content-', CAST(p_partkey AS STRING)) AS content
FROM part
""",
    "tile_pixels": r"""
SELECT vec_id AS chart_id, 12 AS z, vec_id % 20 AS x, (vec_id DIV 100) % 5 AS y,
       transform(embedding, (v, i) -> CASE WHEN i % 4 < 3 THEN CAST(floor(least(greatest((CAST(v AS DOUBLE) + 0.5) * 255, 0), 255)) AS INT)
                                           WHEN vec_id % 3 = 0 THEN 255 WHEN vec_id % 3 = 1 THEN 0
                                           ELSE CAST((vec_id * 7 + i * 13) % 256 AS INT) END) AS px
FROM embeddings
""",
    "tile_pixels_duckdb": r"""
SELECT vec_id AS chart_id, 12 AS z, vec_id % 20 AS x, (vec_id // 100) % 5 AS y,
       list_transform(embedding, lambda v, j: CASE WHEN (j - 1) % 4 < 3 THEN CAST(floor(least(greatest((CAST(v AS DOUBLE) + 0.5) * 255, 0), 255)) AS INT)
                                           WHEN vec_id % 3 = 0 THEN 255 WHEN vec_id % 3 = 1 THEN 0
                                           ELSE CAST((vec_id * 7 + (j - 1) * 13) % 256 AS INT) END) AS px
FROM embeddings
""",
}
SQL["manifest_new"] = SQL["manifest_old"].replace("s_suppkey * 1000", "s_suppkey * 1000 + 1").replace("% 3 <> 2", "% 3 <> 1")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SQL[name]
    table = re.search(r"FROM (part|orders|lineitem|supplier|region|events|customer|embeddings)\b", text).group(1)
    return spark.sql(re.sub(rf"FROM {table}\b", "FROM {source}", text), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def with_fixtures(*names: str) -> str:
    """The head of a DuckDB query: WITH name AS (...), ..."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL.get(n + '_duckdb', SQL[n])})" for n in names)
