"""Claims as leases: a dead writer is taken over, a late one fails, and running trainings are listed."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest

from vicinal import IVFFlat, VectorStore
from vicinal.sources.index_store import LeaseLost

KEY = bytes(range(32))


@pytest.fixture
def store(spark, tmp_path):
    return VectorStore(spark, str(tmp_path / "store"), lease_seconds=1.0)


def claim(store, version, attempt=0):
    assert store.store.folder.create(f"{store.store.root}/_claims/a/{version:012d}/{attempt:03d}")


def test_a_dead_claim_does_not_block_a_name(store):
    claim(store, 1)
    store.store.lease_seconds = 600.0
    with pytest.raises(ValueError, match="already exists"):
        store.create_index("a", KEY)
    with pytest.raises(LookupError):
        store.load_index("a", KEY)
    store.store.lease_seconds = 0.0
    store.create_index("a", KEY)
    assert store.load_index("a", KEY).count() == 0
    with pytest.raises(ValueError, match="already exists"):
        store.create_index("a", KEY)


def test_updates_wait_for_the_lease_only(store):
    index = store.create_index("a", KEY, IVFFlat(2))
    claim(store, 2)
    start = time.time()
    store.store.update_entry(index._entry(), {"trained_count": 5})
    assert time.time() - start > 0.8 and index._entry()["trained_count"] == 5
    assert index._entry()["version"] == 2 and index._entry()["uid"].startswith("001-")
    assert store.list_indexes().count() == 1 and store.describe("a").first()["trained_count"] == 5


def test_a_late_writer_fails_and_loses_no_update(store, monkeypatch):
    """The slow writer stops before its row is written; another takes over meanwhile."""
    index = store.create_index("a", KEY, IVFFlat(2))
    entry, slow = index._entry(), VectorStore(store.spark, store.store.root, lease_seconds=1.0).store
    claimed, go = threading.Event(), threading.Event()
    write = slow._write_entry

    def later(*arguments):
        claimed.set()
        go.wait(30)
        write(*arguments)

    monkeypatch.setattr(slow, "_write_entry", later)
    with ThreadPoolExecutor(1) as pool:
        late = pool.submit(slow.append_entry, {**entry, "n_lists": 7})
        assert claimed.wait(30)
        store.store.update_entry(entry, {"trained_count": 9})
        go.set()
        with pytest.raises(LeaseLost):
            late.result()
    newest = index._entry()
    assert (newest["version"], newest["trained_count"], newest["n_lists"]) == (2, 9, None)
    assert store.describe("a").first()["trained_count"] == 9
    store.store.update_entry(newest, {"n_lists": 3})
    assert (index._entry()["trained_count"], index._entry()["n_lists"]) == (9, 3)


def test_one_taker_backs_off_when_the_version_is_there(store, monkeypatch):
    """A writer that claims the next attempt just as the first one commits leaves the version alone."""
    index = store.create_index("a", KEY, IVFFlat(2))
    entry = index._entry()
    claim(store, 2)
    time.sleep(1.2)
    create = store.store.folder.create

    def slip_in(path):
        done = create(path)
        store.store._write_entry({**entry, "version": 2, "uid": "000-x", "n_lists": 4}, f"{store.store.catalog_path}/a/{2:012d}-000")
        monkeypatch.setattr(store.store.folder, "create", create)
        return done

    monkeypatch.setattr(store.store.folder, "create", slip_in)
    store.store.update_entry(entry, {"trained_count": 1})
    assert (index._entry()["version"], index._entry()["n_lists"], index._entry()["trained_count"]) == (3, 4, 1)


def test_running_trainings(store, random_items):
    index = store.create_index("a", KEY, IVFFlat(3), encrypt=())
    index.upsert(random_items(np.random.default_rng(1).normal(size=(50, 3))), auto_train=False)
    assert store.training_running().collect() == []
    with store.store.training_mark(index._entry()):
        time.sleep(1.5)  # longer than the lease: it was renewed
        assert [tuple(r) for r in store.training_running().collect()] == [("a", 1)] and index.status().first()["is_training"]
    assert store.training_running().collect() == [] and not index.status().first()["is_training"]
    assert store.store.folder.create(f"{store.store.root}/_training/a/dead")
    assert store.store.running_trainings() == [("a", 1)]
    time.sleep(1.2)
    assert store.store.running_trainings() == []
