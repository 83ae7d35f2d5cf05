"""Seconds of the core rules over stored events: one pass per topic against one pass per rule.

    python benchmarks/shared_panes.py [copies of the events] [folder of the test tables]

Events are those of the test tables, repeated with times that follow one another.

Measured with 20 copies (2 million events a topic, local files, 8 threads): one pass per topic 20.9 s,
one pass per rule 10.5 s, one pass per rule with exact counts 15.0 s.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logwarden.operators.detect import detect, detect_all, union_all  # noqa: E402
from logwarden.operators.rules import CORE_RULES  # noqa: E402
from logwarden.schemas import TOPICS  # noqa: E402
from logwarden.sources import event_views as views  # noqa: E402


def main(copies: int = 20, sf_dir: str = "/root/testdata/sf0.1") -> None:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="shared-panes-")
    shift = F.expr("timestamp + copy * INTERVAL '11000' SECOND")
    topics = {}
    for topic in TOPICS:
        events = views.topic_view(spark, sf_dir, topic).drop("event_id")
        many = events.crossJoin(spark.range(copies).withColumnRenamed("id", "copy"))
        many.withColumn("timestamp", shift).drop("copy").write.parquet(f"{folder}/{topic}")
        topics[topic] = spark.read.parquet(f"{folder}/{topic}")
    print("events a topic:", topics["auth"].count())
    ways = {
        "one pass per topic": lambda: detect_all(topics, CORE_RULES, "approx", one_pass=True),
        "one pass per rule": lambda: union_all(detect(topics[r.topic], r, "approx") for r in CORE_RULES),
        "one pass per rule, exact": lambda: union_all(detect(topics[r.topic], r, "exact") for r in CORE_RULES),
    }
    for _ in range(2):
        for name, alerts in ways.items():
            start = time.perf_counter()
            alerts().write.format("noop").mode("overwrite").save()
            print(name, round(time.perf_counter() - start, 2))
    spark.stop()


if __name__ == "__main__":
    main(*(kind(x) for kind, x in zip((int, str), sys.argv[1:])))
