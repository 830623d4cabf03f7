"""Loading the driver's tables (one parquet file per table under ``sf_dir``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SPREAD_CONF = "spark.furiframe.spreadScans"

# Tables whose rows carry heavy per-row work (text, arrays), with their key.
_SPREAD = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn"),
           "embeddings": ("vec_id",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; column pruning and filters reach the scan.

    A session that sets ``spark.furiframe.spreadScans`` to a number of partitions
    has the rows of heavy tables dealt to that many by their unique key: for
    inputs of one small file, which are one task otherwise. Unset (as on a
    cluster, where files are many), there is no exchange.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    spread = spark.conf.get(SPREAD_CONF, None)
    if spread and name in _SPREAD:
        df = df.repartition(int(spread), *_SPREAD[name])
    return df
