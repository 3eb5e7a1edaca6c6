"""Plan-shape regression tests for the scale properties the operators promise."""

import re

from tests.conftest import SF_SMALL
from colloquy.plans import suite


def plan_of(spark, name):
    df = suite.QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_reply_scoring_crosses_into_python_once(spark):
    plan = plan_of(spark, "pass_accuracy")
    assert len(re.findall(r"ArrowEvalPython", plan)) == 1  # gold and prediction keys in one node


def test_typed_validation_collects_nothing(spark):
    plan = plan_of(spark, "validate_turns")
    assert "collect_list" not in plan and "Window" not in plan


def test_response_span_windows_are_block_scoped(spark):
    plan = plan_of(spark, "response_spans")
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    over_turns = [ln for ln in windows if re.search(r"\], \[[^\]]*\], \[turn#", ln)]
    assert over_turns and all(re.search(r"\], \[conv_id#\d+L, _blk#\d+L\], \[turn#", ln) for ln in over_turns)


def test_robustness_parses_each_reply_once_and_builds_without_a_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "robustness")
    plan = plan_of(spark, "robustness")
    begun = len(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("", "")
    assert begun <= 1  # the schema of one file
    # one step over the replies, one over the chosen references; only texts that are not simple reach it
    assert plan.count("ArrowEvalPython") == 2 and "ExistingRDD" not in plan
    assert "CASE WHEN NOT" in plan.split("ArrowEvalPython")[1]


def test_packing_counts_tokens_once_and_builds_without_a_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building-packing", "doc_packing")
    df = suite.QUERIES["doc_packing"](spark, SF_SMALL)
    begun = len(tracker.getJobIdsForGroup("building-packing"))
    spark.sparkContext.setJobGroup("", "")
    assert begun <= 1  # the schema of one file
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan  # block totals and running sums read one exchange


def test_scans_are_pruned(spark):
    plan = plan_of(spark, "dataset_stats")
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("turn" not in r for r in read)  # only conv_id, role, text are read


def test_markers_of_a_reply_are_found_by_one_split(spark):
    """No search for each marker, and no pattern over each line, in the usual layout."""
    plan = plan_of(spark, "reply_scores")
    assert len(re.findall(r"instr\(generated#\d+, PASS_", plan)) <= 2  # once, for texts of another layout (tested, then used)
    assert "(?U)" not in plan
