"""Entry point for ``spark-submit``; see ``edgeloom/cli.py``."""

import sys

from pyspark.sql import SparkSession

from edgeloom.cli import run

if __name__ == "__main__":
    session = SparkSession.builder.appName("edgeloom").getOrCreate()
    run(session, sys.argv[1:])
    session.stop()
