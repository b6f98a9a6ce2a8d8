"""Shared folder, command line."""

from datetime import datetime

import pyarrow as pa
import pytest

from stationlake import session
from stationlake.__main__ import parse


class FakeSession:
    def __init__(self, **conf):
        self.values = {k.replace("__", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_the_cluster_names_the_shared_folder():
    fake = FakeSession(spark__checkpoint__dir="hdfs://shared/", spark__master="yarn")
    assert session.shared_dir(fake) == "hdfs://shared"
    first, second = (session.scratch_path(fake, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/x-") and first != second


def test_only_a_local_session_may_make_its_own():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession(spark__master="yarn"))
    local = FakeSession(spark__master="local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_materialise_reads_back_what_it_wrote(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    back = session.materialise(df)
    assert "FileScan" in back._jdf.queryExecution().executedPlan().toString()
    assert sorted(back.collect()) == sorted(df.collect())


def test_command_line():
    job, cfg = parse(
        ["silver", "--run-at", "2024-01-30T10:00:00", "--silver-days", "0", "--silver-path", "s"]
    )
    assert (job, cfg.silver_days, cfg.silver_path) == ("silver", 0, "s")
    assert cfg.run_at == datetime(2024, 1, 30, 10)
    job, cfg = parse(["gold", "--gold-mode", "replace_days", "--polluted-keep", "a", "b"])
    assert (cfg.gold_mode, cfg.polluted_keep, cfg.gold_days) == ("replace_days", ("a", "b"), 3)


def test_batches_are_small_only_inside(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def largest():
        def count(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        found = spark.range(0, 100, 1, 1).mapInArrow(count, "n long").collect()
        return max(r.n for r in found)

    before = spark.conf.get(name, None)
    with session.small_batches(spark, 7):
        assert largest() == 7
        with session.small_batches(spark, 9):  # the smaller one holds
            assert largest() == 7
    assert largest() == 100 and spark.conf.get(name, None) == before
    with pytest.raises(ZeroDivisionError), session.small_batches(spark, 7):
        1 / 0
    assert spark.conf.get(name, None) == before
