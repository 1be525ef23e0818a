"""Scale guards: physical plan shapes."""

import pytest

from ledgerline.plans.registry import load_all
from tests.conftest import SF001


def formatted(spark, df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def reg():
    return load_all()


def test_no_python_udf_and_no_cartesian(spark, reg):
    for name, r in reg.items():
        text = formatted(spark, r.build(spark, SF001))
        assert "BatchEvalPython" not in text, name
        assert "ArrowEvalPython" not in text, name
        assert "CartesianProduct" not in text, name


def test_anti_join_prunes_and_preaggregates_history(spark, reg):
    text = formatted(spark, reg["new_rows_composite_key"].build(spark, SF001))
    assert "LeftAnti" in text
    assert "LessThan(l_shipdate,1998-01-01T00:00), GreaterThan(l_discount,0.0)]" in text
    # history side is aggregated (distinct keys) before it is joined
    assert text.count("HashAggregate") >= 2


def test_keep_first_is_limited_before_the_shuffle(spark, reg):
    text = formatted(spark, reg["dedupe_keep_first"].build(spark, SF001))
    assert "WindowGroupLimit" in text


def test_contains_match_is_an_equi_join(spark, reg):
    text = formatted(spark, reg["contains_first_match"].build(spark, SF001))
    assert "NestedLoopJoin" not in text


def test_watermark_reaches_the_scan(spark, reg):
    text = formatted(spark, reg["watermark_increment"].build(spark, SF001))
    assert "GreaterThan(o_orderdate" in text


def test_loader_shuffles_nothing_to_compare_with_small_history(spark, reg):
    text = formatted(spark, reg["job_order_loader"].build(spark, SF001))
    assert "LeftAnti" in text and "BroadcastExchange" in text


def test_period_is_a_range_at_the_scan(spark, reg):
    text = formatted(spark, reg["period_filter"].build(spark, SF001))
    assert "GreaterThanOrEqual(" in text and "LessThan(" in text


def test_legalised_reads_history_once(spark, reg):
    text = formatted(spark, reg["job_legalised"].build(spark, SF001))
    assert text.split("\n\n")[0].count("LeftAnti") == 1


def test_joins_of_hot_keys_can_be_cut(spark):
    """Both sides come straight from a shuffle, so adaptive execution may split them."""
    from ledgerline.operators.dedupe import duplicate_flag
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in keep:
            spark.conf.set(k, "-1")
        text = formatted(spark, duplicate_flag(spark.range(100).selectExpr("id % 3 AS k", "id"), ["k"], "dup"))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    tree = text.split("\n\n")[0]
    assert "SortMergeJoin" in tree and tree.count("Exchange") == 3  # rows, counts, counts again by the join's keys
