"""Session utilities: shared folder, materialization, size estimate."""

from __future__ import annotations

from shelfgate import session


def test_shared_dir_is_stable_and_local_only_when_unset(spark):
    a, b = session.shared_dir(spark), session.shared_dir(spark)
    assert a == b
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()


def test_materialize_cuts_the_lineage(spark):
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    written = session.materialize(df, "t")
    assert written.count() == 7
    plan = written._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Aggregate" not in plan      # lineage cut: a scan of the table


def test_size_estimate_and_scratch_paths(spark):
    df = spark.range(10)
    assert session.estimated_bytes(df) > 0
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_drop_scratch_takes_old_helper_tables_alone(spark, monkeypatch, tmp_path):
    from shelfgate import session

    monkeypatch.setattr(session, "shared_dir", lambda s: str(tmp_path))
    session.materialize(spark.range(3), "old-one")
    kept = spark.range(3)
    kept.write.parquet(str(tmp_path / "users-table"))
    assert session.drop_scratch(spark, older_than_hours=1) == []
    gone = session.drop_scratch(spark, older_than_hours=-1)
    assert len(gone) == 1 and "/old-one-" in gone[0]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["users-table"]
