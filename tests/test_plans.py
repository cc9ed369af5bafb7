"""Plan shape: the properties the scale design relies on, read from explain()."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from recforge.operators.embeddings import top_k_by_score
from recforge.plans.samples import training_samples
from recforge.sources import fixtures as fx

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_history_is_one_window_with_pruned_scans(spark):
    plan = _plan(training_samples(fx.ratings(spark, SF_SMALL), fx.products(spark, SF_SMALL), fx.RATING_ORDER))
    windows = [line for line in plan.splitlines() if re.fullmatch(r"\(\d+\) Window", line.strip())]
    assert len(windows) == 1
    # unused lineitem columns never reach the scan
    assert "l_tax" not in plan and "l_comment" not in plan and "l_returnflag" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top_k_is_limited_before_the_shuffle(spark):
    r = fx.ratings(spark, SF_SMALL)
    plan = _plan(top_k_by_score(r, "userId", "productId", "rating", 10))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_positive_filter_reaches_scan_projection(spark):
    r = fx.ratings(spark, SF_SMALL).where(F.col("rating") >= 3.5).select("userId")
    plan = _plan(r)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
