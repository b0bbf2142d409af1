"""File ledger: repeated loads, new and replaced files, two loads at once."""

import os

import pytest

from bazaar.sinks import versions
from bazaar.sources import ledger as L
from tests.test_sources import put


@pytest.fixture
def base(tmp_path):
    put(tmp_path / "in" / "d1", "a.csv", "1\n")
    put(tmp_path / "in" / "d2", "b.csv", "2\n")
    put(tmp_path / "in" / "d2", "notes.txt", "x\n")
    return str(tmp_path / "in")


def files(df):
    return sorted(os.path.basename(p) for p in L.paths(df))


def test_every_arrival_is_claimed_once(spark, base, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert files(L.claim(spark, ledger, base, "one", "*.csv")) == ["a.csv", "b.csv"]
    assert files(L.claim(spark, ledger, base, "two", "*.csv")) == []
    put(tmp_path / "in" / "d3", "c.csv", "3\n")
    put(tmp_path / "in" / "d1", "a.csv", "replaced\n")
    assert files(L.claim(spark, ledger, base, "one", "*.csv")) == ["a.csv", "b.csv"]  # a repeat gets what it had
    assert files(L.claim(spark, ledger, base, "two", "*.csv")) == ["a.csv", "c.csv"]
    os.utime(f"{base}/d2/b.csv", (1, 1))  # same size, another time
    assert files(L.claim(spark, ledger, base, "three", "*.csv")) == ["b.csv"]
    assert L.arrivals(spark, ledger, base, "*.csv").count() == 0
    assert files(L.arrivals(spark, ledger, base)) == ["notes.txt"]


def test_failed_loads_are_named(spark, base, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert L.unfinished(spark, ledger) == []
    L.claim(spark, ledger, base, "one")
    assert L.unfinished(spark, ledger) == ["one"]
    L.finish(spark, ledger, "one")
    assert L.unfinished(spark, ledger) == []


def test_two_loads_at_once(spark, base, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    publish = versions.publish

    def other_first(*args):
        monkeypatch.setattr(versions, "publish", publish)
        L.claim(spark, ledger, base, "other")
        publish(*args)

    monkeypatch.setattr(versions, "publish", other_first)
    with pytest.raises(versions.LoadConflictError):
        L.claim(spark, ledger, base, "mine")
    assert files(L.claim(spark, ledger, base, "mine")) == [] and len(files(L.claim(spark, ledger, base, "other"))) == 3


def test_listing_reads_no_content(spark, base):
    plan = L.list_files(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
