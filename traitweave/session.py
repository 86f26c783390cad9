"""Session settings that suit wide phenotype queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that can be changed on a running session.
RECOMMENDED_SETTINGS = {
    # The JVM does not compile methods over 8000 bytes of bytecode. Code generated for a hundred flags
    # at once exceeds that and would be interpreted; under this limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> None:
    """Apply the recommended settings to a session."""
    for name, value in RECOMMENDED_SETTINGS.items():
        spark.conf.set(name, value)
