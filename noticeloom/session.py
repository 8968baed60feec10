"""Session settings shared by the entry point, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "noticeloom", **conf: str) -> SparkSession:
    """A session with UTC, AQE and shuffle partitions sized to a local run; a cluster passes its own settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.master(master).appName(app).config(map=settings).getOrCreate()
