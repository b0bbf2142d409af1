"""Retry counters in state: doubled, lost and late messages, expiry, restart."""

import datetime as dt

from pyspark.sql import functions as F

from bazaar.streaming import retry_state as R
from tests.test_operators import rows

HOUR = dt.timedelta(hours=1)
SCHEMA = "item string, failure_id string, failed_at timestamp, note int"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


#: (item, id, minute): item a is doubled in one batch and in the next, b pauses for longer than an hour.
ARRIVALS = [
    [("a", "1", 0), ("a", "1", 0), ("b", "x", 1), ("c", None, 2)],
    [("a", "1", 0), ("a", "2", 10), ("a", "3", 20), ("b", "y", 30)],
    [("a", "4", 30), ("a", "5", 40), ("b", "z", 95), ("b", "z", 95)],
    [("a", "6", 101), ("b", "w", 100)],
]


def run(spark, tmp_path, arrivals):
    """One run of the query for each arrival, all on one checkpoint."""
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    with R.with_rocks(spark):
        for batch in arrivals:
            data = [(i, f, at(m), 7) for i, f, m in batch]
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(SCHEMA).parquet(source)
            counted = R.count_retries(stream, ["item"], HOUR, "3 hours")
            query = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
            query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_counter_survives_doubles_gaps_and_restarts(spark, tmp_path):
    got = run(spark, tmp_path, ARRIVALS)
    want = {
        ("a", "1"): (1, "retry"), ("a", "2"): (2, "retry"), ("a", "3"): (3, "retry"), ("a", "4"): (4, "dead"), ("a", "5"): (5, "dead"),
        ("a", "6"): (1, "retry"), ("b", "x"): (1, "retry"), ("b", "y"): (2, "retry"), ("b", "z"): (1, "retry"), ("b", "w"): (2, "retry"),
        ("c", ""): (1, "retry"),
    }
    found = {(r.item, r.failure_id): (r.retry_count, r.route) for r in got.collect()}
    assert found == want and got.count() == len(want)
    every = spark.createDataFrame([(i, f, at(m), 7) for batch in ARRIVALS for i, f, m in batch], SCHEMA)
    assert rows(R.count_retries_batch(every, ["item"], HOUR)) == rows(got)


def test_batch_counts(spark):
    data = [("a", str(n), at(n), 0) for n in range(6)] + [("a", "9", None, 0), (None, "1", at(0), 0)]
    got = R.count_retries_batch(spark.createDataFrame(data, SCHEMA), ["item"], HOUR, max_retries=2)
    assert got.where("item = 'a'").agg(F.max("retry_count")).first()[0] == 6
    assert got.where("route = 'retry'").count() == 3 and got.count() == 7


def test_many_failures_of_one_item(spark, tmp_path, monkeypatch):
    """Ids that lie in pages are found again, in the same batch and in later ones, until a pause."""
    monkeypatch.setattr(R, "PAGE", 4)
    arrivals = [[("a", f"{n // 2}", n // 2) for n in range(2 * first, 2 * (first + 25))] for first in (0, 20, 40)]
    arrivals.append([("a", "3", 65), ("b", "3", 65), ("a", "3", 200), ("a", "4", 201)])
    got = {(r.item, r.failure_id, r.failed_at): r.retry_count for r in run(spark, tmp_path, arrivals).collect()}
    want = {("a", str(n), at(n)): n + 1 for n in range(65)} | {("b", "3", at(65)): 1, ("a", "3", at(200)): 1, ("a", "4", at(201)): 2}
    assert got == want


class Calls:
    """State of one item that counts the calls to it."""

    def __init__(self):
        self.value, self.pages, self.n = None, {}, 0

    def __getattr__(self, name):
        def call(*given):
            self.n += 1
            if name in ("getValueState", "getMapState"):
                return self
            if name == "update":
                self.value = given[0]
            if name == "updateValue":
                self.pages[given[0]] = given[1]
            if name == "clear":
                self.pages = {}
            if name in ("containsKey", "getValue"):
                return self.pages.get(given[0]) if name == "getValue" else given[0] in self.pages
            return self.value is not None if name == "exists" else self.value

        return call


def test_calls_to_the_state_do_not_grow_with_the_rows():
    from pyspark.sql import Row

    counter, state = R._RetryCounter(["failure_id"], 3, HOUR), Calls()
    counter.init(state)
    for batch in range(3):
        state.n = 0
        rows = [Row(failure_id=str(i), **{R._AT: i}) for i in range(batch * 50, batch * 50 + 50)]
        found = list(counter.handleInputRows(("a",), iter([*rows, *rows]), None))
        assert [r.retry_count for r in found] == list(range(batch * 50 + 1, batch * 50 + 51))
        assert state.n <= 5
