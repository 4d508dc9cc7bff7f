"""State that grows by batches: days, blocklists, samples and snapshots, each committed in one step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.corpus import merge_feed
from vigil.operators.samples import high_water, merge_samples
from vigil.sources.versions import Store, update

FEED, DAYS = "feed", "evidence"
SAMPLES, SAMPLE_IOCS, MARKS = "samples", "sample_iocs", "high_water"


def replace_days(store: Store, rows: DataFrame, mark: tuple[str, int] | None = None) -> int:
    """Replace the report days that ``rows`` hold; the others are carried over by name, so a day costs the same whatever the corpus holds."""
    return store.commit({DAYS: rows}, mark, {DAYS: "report_date"})


def advance_feed(store: Store, listed: DataFrame, ok_sources: DataFrame, now: Column, mark: tuple[str, int] | None = None) -> int:
    """The next state of the blocklist table, as ``merge_feed`` has it."""
    def change(version: int) -> dict[str, DataFrame]:
        stored = store.read(FEED, version) if version and store.has(FEED) else listed.limit(0)
        return {FEED: merge_feed(stored, listed, ok_sources, now).drop("change")}

    return update(store, change, mark)


def advance_samples(store: Store, samples: DataFrame, iocs: DataFrame, mark: tuple[str, int] | None = None) -> int:
    """Samples (sha256, finished_at) and their indicators (sha256) replace the stored ones of the same sample; the high-water row moves in the same commit.

    All indicators of a sample that comes again are replaced, as its new analysis may have fewer.
    """
    def change(version: int) -> dict[str, DataFrame]:
        if not version or not store.has(SAMPLES):
            none = samples.sparkSession.createDataFrame([], f"high_water {samples.schema['finished_at'].dataType.simpleString()}")
            return {SAMPLES: samples.dropDuplicates(["sha256"]), SAMPLE_IOCS: iocs, MARKS: high_water(samples, none)}
        kept = store.read(SAMPLE_IOCS, version).join(samples.select("sha256").distinct(), "sha256", "left_anti")
        return {SAMPLES: merge_samples(store.read(SAMPLES, version), samples), SAMPLE_IOCS: kept.select(iocs.columns).unionByName(iocs),
                MARKS: high_water(samples, store.read(MARKS, version))}

    return update(store, change, mark)


def write_snapshot(store: Store, tables: dict[str, DataFrame], mark: tuple[str, int] | None = None) -> int:
    """All tables of a snapshot (values, excluded, cve, coverage, rules, version) under one version."""
    return store.commit(tables, mark)


def ingest_new_samples(store: Store, pages: Callable[[int], DataFrame | None], iocs_of: Callable[[DataFrame], DataFrame]) -> int:
    """Read listed jobs page by page, newest first, until a page reaches behind the committed mark, and commit those beyond it with the new mark.

    pages(k): the k-th page of jobs (sha256, finished_at), null after the last. A job at the mark itself was read by the run that set
    it. The mark only moves with the commit, so a run that fails is read again whole; returns the number of pages read.
    """
    known = store.read(MARKS).first() if store.has(MARKS) else None
    water, taken, k = known[0] if known else None, None, 0
    while (page := pages(k)) is not None:
        k += 1
        new = page if water is None else page.where(F.col("finished_at") > F.lit(water))
        taken = new if taken is None else taken.unionByName(new)
        oldest = page.agg(F.min("finished_at")).first()[0]
        if oldest is None or (water is not None and oldest <= water):
            break
    if taken is not None and not taken.isEmpty():
        last = taken.groupBy("sha256").agg(F.max_by(F.struct(*[c for c in taken.columns if c != "sha256"]), "finished_at").alias("r")).select("sha256", "r.*")
        advance_samples(store, last.select(taken.columns), iocs_of(last))
    return k
