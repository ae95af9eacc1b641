"""Readers that take from a stream's state only what changed since their last read."""

import pytest
from pyspark.sql import functions as F

from marquee.operators.ratings import merge_voted
from marquee.operators.votes import vote_totals, vote_log
from marquee.registry import adapters
from marquee.sources.messages import file_messages
from marquee.sources.votes import changes_in_state, last_batch, totals_in_state, with_changes
from marquee.streaming import votes as streams

BATCHES = 50


def rows(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def stream(spark, small, tmp_path_factory):
    """A totals stream of 50 batches; the checkpoint and the messages of each batch."""
    folder = str(tmp_path_factory.mktemp("state"))
    messages = adapters.messages(spark, small)
    part = F.pmod(F.xxhash64("msg_offset"), F.lit(BATCHES)).alias("part")
    messages.select("*", part).repartition(1).write.partitionBy("part").parquet(f"{folder}/messages")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        query = streams.start_totals(
            file_messages(spark, f"{folder}/messages/*", files_per_batch=1), f"{folder}/rows", f"{folder}/checkpoint", once=True
        )
        query.awaitTermination()
        assert query.exception() is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return f"{folder}/checkpoint", f"{folder}/rows", messages


def test_changes_after_a_mark(spark, stream):
    checkpoint, written, messages = stream
    assert last_batch(spark, checkpoint) == BATCHES - 1
    whole = rows(vote_totals(vote_log(messages)))
    assert rows(totals_in_state(spark, checkpoint)) == whole
    for mark in (0, 24, 47, 48):
        before = totals_in_state(spark, checkpoint, mark)
        changed = changes_in_state(spark, checkpoint, mark)
        later = spark.read.schema("tconst STRING, dn BIGINT, ds BIGINT, batch_id BIGINT").parquet(written).where(F.col("batch_id") > mark)
        assert {r[0] for r in rows(changed)} == {r["tconst"] for r in later.collect()}
        assert rows(with_changes(before, changed)) == whole
    # In steps, each from the mark that the one before has reached.
    totals, mark = totals_in_state(spark, checkpoint, 9), 9
    for upto in (20, 49):
        totals, mark = with_changes(totals, changes_in_state(spark, checkpoint, mark, upto)), upto
    assert rows(totals) == whole


def test_only_the_batches_after_the_mark_are_read(spark, stream):
    checkpoint, written, _ = stream
    size = {b: n for b, n in rows(spark.read.schema("tconst STRING, batch_id BIGINT").parquet(written).groupBy("batch_id").count())}

    def handed_on(after):
        frame = changes_in_state(spark, checkpoint, after)
        frame.collect()
        node, todo = None, [frame._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
            elif node.getClass().getSimpleName().endswith("QueryStageExec"):
                todo.append(node.plan())
            elif node.children().isEmpty():
                return node.metrics().apply("numOutputRows").value()
            else:
                todo.append(node.children().head())

    for after in (0, 24, 47):
        assert handed_on(after) == sum(n for b, n in size.items() if b > after)


def test_nothing_new(spark, stream, small):
    checkpoint, *_ = stream
    assert changes_in_state(spark, checkpoint, BATCHES - 1).count() == 0
    assert last_batch(spark, "/nowhere/checkpoint") == -1
    # Live ratings of what changed, without a scan of all ratings per batch.
    live = merge_voted(adapters.ratings(spark, small), changes_in_state(spark, checkpoint, BATCHES - 2))
    assert live.count() <= changes_in_state(spark, checkpoint, BATCHES - 2).count()
