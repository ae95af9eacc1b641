"""Folding by key ranges against folding at once, and what it writes and removes."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import ratings as rating_ops
from marquee.operators.votes import vote_log
from marquee.registry import adapters
from marquee.schemas import RAW_SCHEMAS
from marquee.sinks.tables import write_copy
from marquee.sources.messages import file_messages
from marquee.sources.tables import load_table
from marquee.streaming import range_folds as folds

TOTALS = "tconst STRING, dn BIGINT, ds BIGINT"
TITLES = [f"tt{k:07d}" for k in range(400)]


def rounded(frame):
    rows = frame.withColumn("averageRating", F.round("averageRating", 9)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture
def ratings(spark, tmp_path):
    table = spark.createDataFrame([(t, f"{k % 10}.5", k) for k, t in enumerate(TITLES)], RAW_SCHEMAS["title_ratings"])
    write_copy(table, str(tmp_path / "w"), "title_ratings")
    return load_table(spark, str(tmp_path / "w"), "title_ratings")


def totals(spark, rows):
    return spark.createDataFrame(rows, TOTALS)


def files(root):
    return {p: p.stat().st_size for p in root.glob("data/batch=*/range=*/*.parquet")}


def test_batches_by_range_equal_folding_at_once(spark, small, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "fold")
    adapters.messages(spark, small).repartition(3, "msg_offset").write.parquet(source)
    dump = adapters.ratings(spark, small)
    query = folds.start_range_folding(
        file_messages(spark, source, files_per_batch=1), dump, root, str(tmp_path / "cp"), once=True, ranges=16
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 2
    expected = rating_ops.fold_votes(dump, vote_log(spark.read.parquet(source)))
    assert rounded(folds.load_folded_ranges(spark, root)) == rounded(expected)


def test_a_batch_writes_the_ranges_it_touches(spark, ratings, tmp_path):
    root = tmp_path / "fold"
    folds.fold_batch(totals(spark, [(TITLES[0], 1, 5)]), ratings, str(root), 0, ranges=32)
    first = files(root)
    folds.fold_batch(totals(spark, [(TITLES[7], 2, 9), ("new", 1, 4)]), ratings, str(root), 1, ranges=32)
    later = {p: size for p, size in files(root).items() if p not in first}
    assert 1 <= len({p.parent for p in later}) <= 2
    assert sum(later.values()) < sum(first.values()) / 8
    both = totals(spark, [(TITLES[0], 1, 5), (TITLES[7], 2, 9), ("new", 1, 4)])
    assert rounded(folds.load_folded_ranges(spark, str(root))) == rounded(rating_ops.fold_totals(ratings, both))


def test_a_batch_done_again_adds_nothing(spark, ratings, tmp_path):
    root, batch = str(tmp_path / "fold"), totals(spark, [(TITLES[3], 2, 20)])
    folds.fold_batch(batch, ratings, root, 0)
    once = rounded(folds.load_folded_ranges(spark, root))
    folds.fold_batch(batch, ratings, root, 0)
    assert rounded(folds.load_folded_ranges(spark, root)) == once
    # Cut short before its index: files are there, nobody reads them, the batch is done anew.
    folds.fold_batch(batch, ratings, root, 1)
    twice = rounded(folds.load_folded_ranges(spark, root))
    (tmp_path / "fold" / "index" / "1.json").unlink()
    assert rounded(folds.load_folded_ranges(spark, root)) == once
    folds.fold_batch(batch, ratings, root, 1)
    assert rounded(folds.load_folded_ranges(spark, root)) == twice
    with pytest.raises(ValueError, match="another checkpoint"):
        folds.fold_batch(batch, ratings, root, 0)


def test_a_refresh_is_taken_up(spark, ratings, tmp_path):
    root = str(tmp_path / "fold")
    folds.fold_batch(totals(spark, [(TITLES[1], 1, 9), ("gone", 1, 3)]), ratings, root, 0, ranges=8)
    table = spark.createDataFrame([(TITLES[1], "2.0", 10), (TITLES[1], "3.0", 4)], RAW_SCHEMAS["title_ratings"])
    write_copy(table, str(tmp_path / "w"), "title_ratings")
    new = load_table(spark, str(tmp_path / "w"), "title_ratings")
    folds.fold_batch(totals(spark, [(TITLES[1], 1, 1)]), new, root, 1, ranges=8)
    expected = rating_ops.fold_totals(new, totals(spark, [(TITLES[1], 2, 10), ("gone", 1, 3)]))
    assert rounded(folds.load_folded_ranges(spark, root)) == rounded(expected)
    folds.fold_batch(totals(spark, [(TITLES[1], 1, 1)]), new, root, 2, ranges=8)
    expected = rating_ops.fold_totals(new, totals(spark, [(TITLES[1], 3, 11), ("gone", 1, 3)]))
    assert rounded(folds.load_folded_ranges(spark, root)) == rounded(expected)


def test_old_files_go_and_kept_ones_stay(spark, ratings, tmp_path):
    root = tmp_path / "fold"
    sizes = []
    for batch in range(7):
        folds.fold_batch(totals(spark, [(TITLES[0], 1, 5)]), ratings, str(root), batch, ranges=8)
        sizes.append(len({p.parent for p in files(root)}))
    assert sizes[-1] == sizes[-2] == sizes[-3] <= 8 + folds.KEPT
    assert sorted(p.name for p in (root / "index").glob("*.json")) == ["4.json", "5.json", "6.json"]
    expected = rating_ops.fold_totals(ratings, totals(spark, [(TITLES[0], 7, 35)]))
    assert rounded(folds.load_folded_ranges(spark, str(root))) == rounded(expected)


def test_one_title_is_read_from_its_range(spark, ratings, tmp_path):
    root = str(tmp_path / "fold")
    folds.fold_batch(totals(spark, [(TITLES[5], 1, 5)]), ratings, root, 0, ranges=32)
    one = folds.load_folded_ranges(spark, root, TITLES[5])
    assert len(one.inputFiles()) == 1
    whole = folds.load_folded_ranges(spark, root).where(F.col("tconst") == TITLES[5])
    assert rounded(one) == rounded(whole) and one.count() == 1
    assert folds.load_folded_ranges(spark, root, "nobody").count() == 0


def test_no_ratings_and_no_votes(spark, tmp_path):
    root, none = str(tmp_path / "fold"), spark.createDataFrame([], RAW_SCHEMAS["title_ratings"])
    folds.fold_batch(totals(spark, []), none, root, 0)
    assert folds.load_folded_ranges(spark, root).count() == 0
    folds.fold_batch(totals(spark, [("tt1", 2, 9)]), none, root, 1)
    assert rounded(folds.load_folded_ranges(spark, root)) == [("tt1", 4.5, 2)]
