"""Domain tables derived from the star-schema test tables.

One SQL text per table serves both engines; rain values are whole numbers held
as doubles, so sums are exact in any order. Missing rain is NaN on the Spark
side, as it comes from files, and NULL in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.operators.cleaning import RAW_YIELD
from agroflow.sources.tables import nan_to_null
from agroflow.sources.workspace import dealt

RAW_NAMES = {
    "yield_c": RAW_YIELD,
    "n2o_raw": "dN_n2o_emis[kgNha-1]",
    "no3_raw": "dN_no3_leach[kgNha-1]",
    "soc_raw": "C_pool_change[kgCha-1]",
}

CLIMATE = """
SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN MIN(l_orderkey) % 97 = 0 THEN {missing}
            ELSE SUM(GREATEST(l_quantity - 25, 0)) END AS prec,
       SUM(ROUND(l_discount * 100)) - 5 AS tavg
FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

CLASSES = """
SELECT s_suppkey AS id,
       CASE WHEN s_suppkey % 32 = 5 THEN CAST(31.055 AS DOUBLE)
            WHEN s_suppkey % 32 = 7 THEN NULL
            ELSE CAST(26 + s_suppkey % 32 AS DOUBLE) END AS aridity_index
FROM {supplier}
"""

# A customer's orders of a year are so many simulations; number 0 has no outputs.
NUMBERED = """
SELECT o_custkey, YEAR(o_orderdate) AS year, o_orderkey, o_totalprice, o_orderpriority, o_orderstatus,
       ROW_NUMBER() OVER (PARTITION BY o_custkey, YEAR(o_orderdate) ORDER BY o_orderkey) AS rn
FROM {orders}
"""

SIMS = """
SELECT c_custkey * 100 + rn AS event_id,
       CASE WHEN c_custkey % 50 = 49 THEN CAST(999999 AS BIGINT)
            ELSE (c_custkey + rn * 31) % (SELECT COUNT(*) FROM {supplier}) END AS climate_id,
       (c_custkey * 17 + rn) % (SELECT COUNT(*) FROM {part}) AS site_id, c_custkey % 7 AS setup_id, c_name AS folder
FROM {customer} JOIN (SELECT o_custkey, CAST(rn AS BIGINT) AS rn FROM (""" + NUMBERED + """) n GROUP BY o_custkey, rn
                      UNION ALL SELECT c_custkey AS o_custkey, CAST(0 AS BIGINT) AS rn FROM {customer}) q
  ON c_custkey = o_custkey
"""

SOIL = """
SELECT p_partkey AS site_id, CAST(p_size AS DOUBLE) AS clay, p_brand AS JB_Classes
FROM {part} WHERE p_partkey % 18 <> 17
"""

OUTPUTS = """
SELECT id, year,
       CAST(k % 4 * 70 AS DOUBLE) AS n_org_amount,
       CAST(k % 5 * 60 AS DOUBLE) AS n_synthamount,
       CASE WHEN k % 11 = 0 THEN 'none' WHEN k % 3 = 0 THEN 'slurry' ELSE 'solid' END AS n_org_type,
       CASE WHEN k % 13 = 0 THEN 'none' WHEN k % 2 = 0 THEN 'urea' ELSE 'nitrate' END AS n_synth_type,
       CAST(1 + k % 3 AS INT) AS n_org_replication,
       CAST(1 + k % 7 % 3 AS INT) AS n_synth_replication,
       CAST(k % 40 - 20 AS DOUBLE) AS manu_daytoplanting,
       CAST(k % 90 + 5 AS DOUBLE) AS fert_daytoplanting,
       CAST(CASE WHEN k % 9 = 0 THEN NULL ELSE k % 40 - 20 END AS DOUBLE) AS manu_daytoplanting_1,
       CAST(CASE WHEN k % 3 < 1 THEN NULL ELSE k % 40 + 10 END AS DOUBLE) AS manu_daytoplanting_2,
       CAST(CASE WHEN k % 3 < 2 THEN NULL ELSE k % 40 + 40 END AS DOUBLE) AS manu_daytoplanting_3,
       CAST(CASE WHEN k % 8 = 0 THEN NULL ELSE k % 90 + 5 END AS DOUBLE) AS fert_daytoplanting_1,
       CAST(CASE WHEN k % 7 % 3 < 1 THEN NULL ELSE k % 90 + 30 END AS DOUBLE) AS fert_daytoplanting_2,
       CAST(CASE WHEN k % 7 % 3 < 2 THEN NULL ELSE k % 90 + 60 END AS DOUBLE) AS fert_daytoplanting_3,
       CAST(k % 4 * 70 AS DOUBLE) AS manu_amount, CAST(k % 5 * 60 AS DOUBLE) AS fert_amount,
       CAST(k % 17 AS DOUBLE) AS manu_amount_1, CAST(k % 16 AS DOUBLE) AS manu_amount_2,
       CAST(CASE WHEN k % 6 = 0 THEN NULL ELSE k % 15 END AS DOUBLE) AS manu_amount_3,
       CAST(k % 19 AS DOUBLE) AS fert_amount_1, CAST(k % 18 AS DOUBLE) AS fert_amount_2,
       CAST(CASE WHEN k % 6 = 1 THEN NULL ELSE k % 14 END AS DOUBLE) AS fert_amount_3,
       CAST(1 AS DOUBLE) AS manu_rate_1, CAST(1 AS DOUBLE) AS manu_rate_2, CAST(1 AS DOUBLE) AS manu_rate_3,
       CAST(1 AS DOUBLE) AS fert_rate_1, CAST(1 AS DOUBLE) AS fert_rate_2, CAST(1 AS DOUBLE) AS fert_rate_3,
       CASE WHEN k % 23 = 0 THEN NULL ELSE o_totalprice / 100 END AS yield_c,
       CAST(CASE WHEN k % 29 = 0 THEN NULL ELSE k % 101 END AS DOUBLE) AS n2o_raw,
       CAST(k % 211 AS DOUBLE) AS no3_raw, CAST(k % 301 - 150 AS DOUBLE) AS soc_raw,
       CAST(240 + k % 60 AS BIGINT) AS planting_dayofyear,
       CAST(CASE WHEN k % 31 = 0 THEN NULL ELSE 200 + k % 50 END AS BIGINT) AS harvest_dayofyear,
       o_orderpriority AS soil, o_orderstatus AS irrigation,
       CASE WHEN k % 2 = 0 THEN 'dry' ELSE 'wet' END AS climate,
       CASE WHEN k % 5 = 0 THEN NULL ELSE CONCAT('system ', CAST(k % 5 AS STRING)) END AS cropping_systems,
       CONCAT('R', CAST(k % 400 AS STRING)) AS crop_rotation,
       CAST(CASE WHEN k % 10 = 0 THEN NULL ELSE k % 4 * 5 END AS DOUBLE) AS manu_depth,
       'wheat' AS crops, 'A' AS crop_rotation_1, 'B' AS crop_rotation_2
FROM (SELECT o_custkey * 100 + rn AS id, CAST(year AS INT) AS year, o_orderkey AS k,
             o_totalprice, o_orderpriority, o_orderstatus
      FROM (""" + NUMBERED + """) n) q
"""

PREDICTIONS = """
SELECT l_returnflag AS target, CAST(l_orderkey % 5 + 1 AS INT) AS fold, l_quantity AS y,
       l_quantity + (l_linenumber - 4) AS y_pred
FROM {lineitem}
"""

VIEWS = {
    "fx_climate": CLIMATE,
    "fx_classes": CLASSES,
    "fx_sims": SIMS,
    "fx_soil": SOIL,
    "fx_outputs": OUTPUTS,
    "fx_predictions": PREDICTIONS,
}
BASE_TABLES = ("lineitem", "orders", "customer", "supplier", "part")

# Years at the ends of the test climate, left out of season features.
EDGE_YEARS = (1995, 2002)


def sql_view(name: str) -> str:
    """The view's text for an engine in which the base tables are registered."""
    return VIEWS[name].format(missing="NULL", **{t: t for t in BASE_TABLES})


class Tables:
    """The domain tables of one scale folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        used = {t: self.base(t) for t in BASE_TABLES if f"{{{t}}}" in VIEWS[name]}
        if name == "fx_climate":
            # Nearly every row is a group of its own: a task adds up a bounded share of them.
            rows = used["lineitem"]
            used["lineitem"] = dealt(rows, rows.count(), "l_suppkey", F.col("l_shipdate").cast("date"))
        text = VIEWS[name].replace("{missing}", "CAST('NaN' AS DOUBLE)")
        return nan_to_null(self.spark.sql(text, **used))

    @property
    def climate(self) -> DataFrame:
        return self._view("fx_climate")

    @property
    def classes(self) -> DataFrame:
        return self._view("fx_classes")

    @property
    def sims(self) -> DataFrame:
        return self._view("fx_sims")

    @property
    def soil(self) -> DataFrame:
        return self._view("fx_soil")

    @property
    def outputs(self) -> DataFrame:
        return self._view("fx_outputs").withColumnsRenamed(RAW_NAMES)

    @property
    def predictions(self) -> DataFrame:
        return self._view("fx_predictions")
