from __future__ import annotations

import random

from trawl.functions import round_exact
from pyspark.sql import functions as F


def test_rounds_like_python(spark):
    rng = random.Random(7)
    values = [a / b for b in range(1, 260) for a in range(0, b + 1, max(1, b // 40))]
    values += [0.0625, 0.1825, 0.3335, 0.8125, 0.0005, 0.0125, 0.0015, 0.9995, 1.0]
    values += [rng.random() for _ in range(5000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for row in rows.select("v", round_exact(F.col("v")).alias("r")).collect():
        assert row["r"] == round(row["v"], 3), row["v"]
