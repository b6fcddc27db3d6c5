"""Filters follow the number of hashes and never miss one."""

import numpy as np
from pyspark.sql import functions as F

from affinia.llm import tables


def test_filter_sizes():
    sizes = [tables.filter_bits(n) for n in (0, 1, 10**5, 10**6, 10**7, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == tables.LEAST_BITS and sizes[-1] == tables.MOST_BITS
    assert all(tables.filter_bits(n) >= tables.BITS_EACH * n for n in (10**5, 10**6, 10**7))


def test_no_hash_is_missed_and_few_others_pass(spark):
    for n in (0, 10, 90_000):
        rows = spark.range(n).select(F.xxhash64("id").alias("h"))
        bits = tables.bit_filter(rows, "h")
        held = np.array([r["h"] for r in rows.collect()], dtype=np.int64).view(np.uint64)
        assert tables.has_bit(bits, held).all() and len(bits) * 8 == tables.filter_bits(n)
        others = np.array([r["h"] for r in spark.range(10**7, 10**7 + 20_000).select(F.xxhash64("id").alias("h")).collect()], dtype=np.int64).view(np.uint64)
        assert tables.has_bit(bits, others).mean() < 0.03
