"""Many small buckets: tasks that write and list them, and readers that list them once."""

import numpy as np

from vicinal import IVFFlat, VectorStore
from vicinal.sources.index_store import _LISTING_CONF, _LISTING_TASKS


def stages(spark, group, work):
    """The tasks of every stage that ran for the call."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    told = [tracker.getStageInfo(stage) for job in jobs if job for stage in job.stageIds]
    return [stage.numTasks for stage in told if stage]


def test_small_buckets_get_no_task_each(spark, tmp_path, random_items):
    matrix = np.random.default_rng(4).normal(size=(400, 8))
    made = VectorStore(spark, str(tmp_path / "store"), bucket_bytes=1 << 8).create_index("a", bytes(range(32)), IVFFlat(8))
    made.upsert(random_items(matrix), auto_train=False)
    before = spark.conf.get(_LISTING_CONF)
    ran = stages(spark, "compact-small", made.compact)
    buckets = made._entry()["buckets"]
    assert buckets > 2 * _LISTING_TASKS and spark.conf.get(_LISTING_CONF) == before
    # Neither the write nor the listing has a task for each bucket.
    assert ran and max(ran) <= _LISTING_TASKS
    made.items()
    assert all(n < _LISTING_TASKS for n in stages(spark, "listed-before", made.items))
    got = {r["id"]: r["vector"] for r in made.items().collect()}
    assert len(got) == 400 and np.allclose(got["7"], matrix[7].astype(np.float32))

    made.delete([str(n) for n in range(300)])
    assert max(stages(spark, "compact-again", made.compact)) <= _LISTING_TASKS
    # What an earlier state listed is not what a later one reads.
    assert sorted(int(r["id"]) for r in made.items().collect()) == list(range(300, 400))
    made.vacuum()
    assert made.items().count() == 100 and made.get(["5", "350"], []).count() == 1
