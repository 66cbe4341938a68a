"""A session of its own for stateful queries.

The state store's provider is a session setting that a query reads when it
starts.  Setting it in the caller's session and setting it back would let two
streams that start together undo each other, so a stateful query runs in a
session beside it: same context, catalog and settings, another provider.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose stateful queries keep their state in RocksDB."""
    beside = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if beside.conf.isModifiable(name):
            beside.conf.set(name, value)
    beside.conf.set(PROVIDER, ROCKSDB)
    return beside
