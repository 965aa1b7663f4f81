"""Changes of tables are one switch: a job that dies leaves the table as it was."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.operators.quality import QualityError
from demandspark.sources import snapshots as S
from demandspark.sources.tables import merge_table, read_table, refresh_range

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("dispensing_date", T.DateType()), T.StructField("v", T.DoubleType())])
DAY = "dispensing_date"


def days(spark, start, n, v, keys=("a", "b")):
    rows = [(k, start + timedelta(days=i), float(v)) for k in keys for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, path):
    return sorted(map(tuple, read_table(spark, path, SCHEMA).collect()))


def refresh(spark, path, start, n, v):
    refresh_range(days(spark, start, n, v), path, DAY, start, start + timedelta(days=n), ["k", DAY])


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark, path, date(2024, 1, 10), 80, 1)
    return path


def test_failure_between_two_months_changes_nothing(spark, table):
    """The write dies in the second of three months, after files of the first are there."""
    before = content(spark, table)
    start, end = date(2024, 1, 20), date(2024, 3, 20)
    dies = F.when(F.col(DAY) == F.lit(date(2024, 2, 15)), F.raise_error("killed").cast("double")).otherwise(F.lit(2.0))
    with pytest.raises(Exception, match="killed"):
        refresh_range(days(spark, start, 60, 2).withColumn("v", dies), table, DAY, start, end, ["k", DAY])
    assert content(spark, table) == before and S.versions(spark, table) == [1]
    refresh(spark, table, start, 60, 2)
    assert {v for _, d, v in content(spark, table) if start <= d < end} == {2.0} and len(content(spark, table)) == 160


def test_failure_before_the_switch_changes_nothing(spark, table, monkeypatch):
    before = content(spark, table)

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(S, "_switch", killed)
    with pytest.raises(RuntimeError):
        refresh(spark, table, date(2024, 2, 1), 20, 3)
    assert content(spark, table) == before
    # what it had written is gone
    assert len(S._names(spark, f"{table}/data")) == 1


def test_violated_keys_never_become_visible(spark, table):
    before = content(spark, table)
    twice = days(spark, date(2024, 2, 1), 5, 4)
    with pytest.raises(QualityError):
        refresh_range(twice.unionByName(twice), table, DAY, date(2024, 2, 1), date(2024, 2, 6), ["k", DAY])
    assert content(spark, table) == before


def test_a_second_writer_fails(spark, table, monkeypatch):
    switch = S._switch

    def slower(spark_, path, names, after):
        monkeypatch.setattr(S, "_switch", switch)
        refresh(spark, path, date(2024, 1, 12), 3, 9)  # another job commits first
        switch(spark_, path, names, after)

    monkeypatch.setattr(S, "_switch", slower)
    with pytest.raises(Exception, match="[Ee]xists"):
        refresh(spark, table, date(2024, 3, 1), 5, 7)
    values = {v for *_, v in content(spark, table)}
    assert values == {1.0, 9.0} and S.versions(spark, table) == [1, 2]


def test_only_touched_partitions_are_written_and_old_versions_go(spark, table):
    first = S.folders(spark, table)
    refresh(spark, table, date(2024, 2, 5), 3, 5)
    second = S.folders(spark, table)
    assert len(set(second) - set(first)) == 1 and len(set(first) & set(second)) == len(first) - 1
    for v in range(3):
        refresh(spark, table, date(2024, 2, 5), 3, v)
    assert S.versions(spark, table) == [4, 5]
    kept = {n for v in (4, 5) for n in S.folders(spark, table, v)}
    there = {f"{c}/{p}" for c in S._names(spark, f"{table}/data") for p in S._names(spark, f"{table}/data/{c}") if "=" in p}
    assert there == kept


def test_months_left_empty_go(spark, table):
    refresh_range(days(spark, date(2024, 2, 1), 0, 0), table, DAY, date(2024, 2, 1), date(2024, 3, 1), ["k", DAY])
    assert {d.month for _, d, _ in content(spark, table)} == {1, 3}


def test_upsert_is_one_switch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    merge_table(days(spark, date(2024, 5, 1), 3, 1), path, SCHEMA, ["k", DAY], ["v"], DAY)
    before = content(spark, path)
    monkeypatch.setattr(S, "_switch", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        merge_table(days(spark, date(2024, 5, 2), 4, 2), path, SCHEMA, ["k", DAY], ["v"], DAY)
    assert content(spark, path) == before
    monkeypatch.undo()
    merge_table(days(spark, date(2024, 5, 2), 4, 2), path, SCHEMA, ["k", DAY], ["v"], DAY)
    assert [v for *_, v in content(spark, path)] == [1.0, 2.0, 2.0, 2.0, 2.0] * 2
