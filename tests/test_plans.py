"""What the plans of registered queries move between tasks."""

import pytest

from cuelattice.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def shuffled_words(frame):
    """Exchanges of a plan that have words below them, which a Generate makes of texts."""
    lines = [line for line in frame._jdf.queryExecution().executedPlan().toString().split("\n") if line.strip()]
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        below = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
        if line.lstrip(" :+-*").startswith("Exchange") and any("Generate" in x for x in lines[i + 1 : below]):
            found.append(line)
    return found


@pytest.mark.parametrize("name", ["surface_restore", "wrap_balanced", "cue_segments", "fused_words", "fusion_counts"])
def test_words_stay_where_their_text_is(spark, name):
    assert shuffled_words(QUERIES[name](spark, SF)) == []


def test_matching_has_tasks_in_proportion_to_the_turns(spark, monkeypatch):
    from cuelattice.plans import fixtures

    monkeypatch.setattr(fixtures, "MATCHED_TURNS", 5, raising=False)
    turns = spark.read.parquet(f"{SF}/conversations.parquet").count()
    plan = QUERIES["consensus_records"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-turns // 5)}), REPARTITION_BY_NUM" in plan
