"""Times the same work done the collecting way: row-at-a-time Python UDF, frames pulled to the driver.

python tools/collect_shape.py [sf_dir]; prints a JSON line of medians, native next to collecting.
"""

import json
import statistics
import sys
import time
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.session import local_session  # noqa: E402
from tideline.operators import drift as D  # noqa: E402
from tideline.operators.gold import to_gold  # noqa: E402
from tideline.plans.queries import LINE_KEYS, MEASURES, _line_sides, _lines  # noqa: E402


def numeric(reference, current):
    points = np.sort(np.concatenate([reference, current]))
    below_r = np.searchsorted(np.sort(reference), points[:-1], "right") / len(reference)
    below_c = np.searchsorted(np.sort(current), points[:-1], "right") / len(current)
    gap = np.abs(below_r - below_c)
    return gap.max(), (gap * np.diff(points)).sum() / max(reference.std(), 0.001)


def categorical(reference, current):
    p, q = reference.value_counts(normalize=True).align(current.value_counts(normalize=True), fill_value=0)
    middle = (p + q) / 2
    return np.sqrt(sum((s[s > 0] * np.log(s[s > 0] / middle[s > 0])).sum() for s in (p, q)) / 2)


def collected_drift(spark, sf_dir):
    reference, current = (side.toPandas() for side in _line_sides(spark, sf_dir))
    for column in reference.columns:
        if reference[column].dtype == float:
            numeric(reference[column].to_numpy(), current[column].to_numpy())
        else:
            categorical(reference[column], current[column])


def native_drift(spark, sf_dir):
    D.drift_report(*_line_sides(spark, sf_dir)).collect()


@F.udf(T.DoubleType())
def summed(a, b, c, d):
    return float(a) + float(b) + float(c) + float(d)


def _written(df):
    df.write.format("noop").mode("overwrite").save()


def udf_score(spark, sf_dir):
    _written(_lines(spark, sf_dir).select(*LINE_KEYS, *MEASURES).withColumn("composite", summed(*MEASURES)))


def native_score(spark, sf_dir):
    _written(to_gold(_lines(spark, sf_dir).select(*LINE_KEYS, *MEASURES), MEASURES, "composite"))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", True)
    medians = {}
    for work in (native_score, udf_score, native_drift, collected_drift):
        times = []
        for _ in range(4):
            started = time.perf_counter()
            work(spark, sf_dir)
            times.append(time.perf_counter() - started)
        medians[work.__name__] = round(statistics.median(times[1:]), 3)
    print(json.dumps(medians))


if __name__ == "__main__":
    main()
