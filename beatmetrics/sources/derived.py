"""Incident tables derived from the TPC-H-like parquet tables.

The rows of ``orders`` become incidents at the place of their customer, every
``customer`` a geocoded place with a ZIP code, every ``nation`` an income row
and a station.  Nulls, sentinels and zero locations come from the keys.  Both
sides of the exact (lat, lon) join use the same arithmetic on the same key, so
the doubles agree bit for bit.  The moduli are prime: places differ for the
first 100 million customers and spread evenly over the same city at any scale.
No place lies exactly between two stations, where rounding would pick one.

The statements are plain SQL that other engines read as well; only the name of
the text type is filled in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _lat(key: str) -> str:
    return f"33.7e0 + 0.000064e0 * (({key} * 7919) % 10007)"


def _lon(key: str) -> str:
    return f"-118.67e0 + 0.00005e0 * (({key} * 104729) % 10009)"


PAIR = "cast(floor((s_suppkey + 1) / 2e0) AS bigint)"

VIEWS = {
    "incidents": f"""
        SELECT lpad(cast(o_orderkey AS {{text}}), 12, '0') AS incident_id,
          o_orderdate AS date_occ,
          lpad(cast(((o_orderkey * 37) % 24) * 100 + (o_orderkey * 7) % 60 AS {{text}}), 4, '0')
            AS time_occ,
          lpad(cast((o_custkey % 25) + 1 AS {{text}}), 2, '0') AS area_code,
          CASE o_orderstatus WHEN 'F' THEN 'STREET' WHEN 'O' THEN 'SIDEWALK'
            ELSE 'PARKING LOT' END AS premise,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL
            ELSE cast(100 + (o_orderkey * 17) % 400 AS {{text}}) END AS weapon_code,
          CASE WHEN o_orderkey % 29 = 0 THEN NULL
            ELSE cast((o_custkey * 7) % 90 AS int) END AS victim_age,
          CASE WHEN o_orderkey % 31 = 0 THEN NULL
            ELSE substr('HBWOAXK', cast(1 + (o_orderkey % 7) AS int), 1) END AS victim_descent,
          CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE {_lat("o_custkey")} END AS lat,
          CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE {_lon("o_custkey")} END AS lon
        FROM orders""",
    "geozip_raw": f"""
        SELECT {_lat("c_custkey")} AS lat, {_lon("c_custkey")} AS lon,
          concat(cast(90001 + c_nationkey AS {{text}}),
            CASE WHEN c_custkey % 4 = 0 THEN '-1234' ELSE '' END) AS zip_raw
        FROM customer""",
    "incomes_raw": """
        SELECT cast(90001 + n_nationkey AS {text}) AS zip, n_name AS community,
          concat('$', cast(20 + (n_nationkey * 13) % 60 AS {text}), ',',
            lpad(cast((n_nationkey * 271) % 1000 AS {text}), 3, '0')) AS income_raw
        FROM nation""",
    "stations": """
        SELECT n_nationkey + 1 AS prec, n_name AS division,
          33.72e0 + 0.11e0 * (n_nationkey % 5) + 0.003e0 AS lat,
          -118.65e0 + 0.1e0 * floor(n_nationkey / 5) + 0.00213e0 AS lon
        FROM nation""",
    "places": f"""
        SELECT c_custkey AS place_id, {_lat("c_custkey")} AS lat, {_lon("c_custkey")} AS lon
        FROM customer""",
    "depots": f"""
        SELECT s_suppkey AS depot_id, {_lat("(s_suppkey * 31 + 17)")} AS site_lat,
          {_lon("(s_suppkey * 31 + 17)")} AS site_lon
        FROM supplier""",
    # A third of the incidents and more under one area.
    "busy_incidents": """
        SELECT lpad(cast(o_orderkey AS {text}), 12, '0') AS incident_id,
          CASE WHEN o_orderkey % 5 < 2 THEN '07' WHEN o_orderkey % 41 = 0 THEN 'n/a'
            WHEN o_orderkey % 43 = 0 THEN NULL
            ELSE lpad(cast((o_custkey % 25) + 1 AS {text}), 2, '0') END AS area_code
        FROM orders""",
    # Two depots at every place, for ties.
    "twin_depots": f"""
        SELECT s_suppkey AS depot_id, {_lat(PAIR)} AS site_lat, {_lon(PAIR)} AS site_lon
        FROM supplier""",
    # A continent's places and a few streets' depots, an ocean apart.
    "outposts": """
        SELECT c_custkey AS place_id, -40e0 + 0.0009e0 * ((c_custkey * 7919) % 10007) AS lat,
          117e0 + 0.0033e0 * ((c_custkey * 104729) % 10009) AS lon
        FROM customer""",
    "crowded_depots": """
        SELECT s_suppkey AS depot_id, 34e0 + 0.000005e0 * ((s_suppkey * 7919) % 10007) AS site_lat,
          -118.3e0 + 0.000005e0 * ((s_suppkey * 104729) % 10009) AS site_lon
        FROM supplier""",
}

# Incidents with repeated numbers, unreadable times and no dates, and places of four ZIP
# codes, each with several income rows and one without a readable income: what the plain
# views have none of.
VIEWS["odd_incidents"] = (
    VIEWS["incidents"]
    .replace(
        "lpad(cast(o_orderkey AS {text}), 12, '0') AS incident_id",
        "lpad(cast(cast(floor(o_orderkey / 9e0) AS bigint) AS {text}), 12, '0') AS incident_id",
    )
    .replace("o_orderdate AS date_occ", "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS date_occ")
    .replace(
        "lpad(cast(((o_orderkey * 37)",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'x9' WHEN o_orderkey % 19 <> 0 THEN lpad(cast(((o_orderkey * 37)",
    )
    .replace("AS {text}), 4, '0')\n            AS time_occ", "AS {text}), 4, '0') END\n            AS time_occ")
)
VIEWS["few_geozip_raw"] = VIEWS["geozip_raw"].replace("90001 + c_nationkey", "90001 + c_nationkey % 4")
VIEWS["few_incomes_raw"] = """
        SELECT cast(90001 + n_nationkey % 4 AS {text}) AS zip, n_name AS community,
          CASE WHEN n_nationkey % 4 = 2 THEN 'unknown'
            ELSE concat('$', cast(30 + (n_nationkey % 4) * 10 AS {text}), ',500') END AS income_raw
        FROM nation"""

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table, or a view derived from one."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    statement = VIEWS[name].format(text="string")
    body, table = statement.rsplit("FROM ", 1)
    return spark.sql(f"{body} FROM {{source}}", source=load(spark, sf_dir, table.strip()))
