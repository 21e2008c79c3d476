"""Facts are combined before they are moved: no exchange carries their raw rows."""

import re

import pytest
from conftest import plan_of

import __spark_entry__  # noqa: F401 - registers the queries
from suite.cases import QUERIES

SF_DIR = "/root/testdata/sf0.01"
FACTS = ("lineitem", "events", "conversations", "documents")
# Nodes that pass rows on one by one.
PASSING = re.compile(
    r"(Project|Filter|Union|Sort|Expand|Generate|ColumnarToRow|InputAdapter|BroadcastHashJoin|"
    r"SortMergeJoin|ShuffledHashJoin)\b")


def tree(plan):
    """(depth, text) of the nodes of a plan printed by ``explain()``."""
    nodes = []
    for line in plan.splitlines():
        if not line.strip() or line.startswith("=="):
            continue
        start = re.search(r"[A-Za-z*]", line).start()
        nodes.append((start, re.sub(r"^\*\(\d+\) ", "", line[start:])))
    return nodes


def raw_sources(nodes, at):
    """Scans whose rows reach node ``at`` without being aggregated or limited."""
    depth, found, skip = nodes[at][0], [], None
    for below, text in nodes[at + 1:]:
        if below <= depth:
            break
        if skip is not None and below > skip:
            continue
        skip = None
        if text.startswith("FileScan"):
            found.append(text)
        elif not PASSING.match(text):
            skip = below
    return found


def moved_facts(plan):
    nodes = tree(plan)
    return [
        source
        for at, (_, text) in enumerate(nodes)
        if re.match(r"(Exchange|BroadcastExchange)\b", text)
        for source in raw_sources(nodes, at)
        if any(f"/{fact}.parquet" in source for fact in FACTS)
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_raw_fact_is_moved(spark, name):
    assert moved_facts(plan_of(QUERIES[name](spark, SF_DIR), "simple")) == []


def test_a_raw_move_is_seen(spark):
    """The check itself: rows of a fact table that are shuffled, or sorted, as they are."""
    facts = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    parts = spark.read.parquet(f"{SF_DIR}/part.parquet")
    assert moved_facts(plan_of(facts.orderBy("l_partkey"), "simple"))
    merged = facts.hint("merge").join(parts, facts.l_partkey == parts.p_partkey)
    assert moved_facts(plan_of(merged, "simple"))
    joined = facts.join(parts.hint("broadcast"), facts.l_partkey == parts.p_partkey)
    assert not moved_facts(plan_of(joined, "simple"))
    assert moved_facts(plan_of(joined.repartition("p_brand"), "simple"))
    assert not moved_facts(plan_of(joined.groupBy("p_brand").count(), "simple"))
