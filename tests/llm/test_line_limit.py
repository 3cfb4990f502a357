"""The limit of shared lines: smooth in the words of a line and the size of a host."""

import brute
import pytest
from pyspark.sql import functions as F

from courtside.llm import quality_rules


def test_no_steps(spark):
    """One word more or a hundredth more documents never changes the limit by much, and it never falls with the host."""
    words, sizes = range(1, 61), [10, 100, 399, 400, 401, 1000, 20_000, 20_200, 10**7]
    df = spark.createDataFrame([(w, n) for w in words for n in sizes], "w int, n long")
    got = {(r.w, r.n): r.limit for r in df.select("w", "n", quality_rules.allowed(F.col("w"), F.col("n")).alias("limit")).collect()}
    assert got == {k: pytest.approx(brute.line_limit(*k)) for k in got}
    for n in sizes:
        assert all(0.55 < got[w + 1, n] / got[w, n] <= 1 for w in words if w > 4 and w + 1 in words)
    for w in words:
        assert all(got[w, a] <= got[w, b] for a, b in zip(sizes, sizes[1:]))
        assert got[w, 401] / got[w, 399] < 1.01 and got[w, 20_200] / got[w, 20_000] < 1.011 and got[w, 10] >= 20
