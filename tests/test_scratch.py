"""Intermediate tables are deleted one by one, or all at once."""

from pathlib import Path

from vigil.plans.materialize import discard, materialize, release, shared_dir


def test_release_deletes_what_is_left(spark):
    release(spark)
    kept, gone = materialize(spark.range(5), "kept"), materialize(spark.range(5), "gone")
    discard(gone)
    assert kept.count() == 5
    folders = lambda: [p.name for p in Path(shared_dir(spark).removeprefix("file://")).iterdir() if p.name.startswith(("kept-", "gone-"))]
    assert len(folders()) == 1 and release(spark) == 2 and folders() == [] and release(spark) == 0
