"""spark-submit run_batch.py <input_dir> <output_dir> [rules.csv]"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tidyledger.batch import run

if __name__ == "__main__":
    if len(sys.argv) not in (3, 4):
        sys.exit(__doc__)
    run(SparkSession.builder.appName("tidyledger").getOrCreate(), *sys.argv[1:])
