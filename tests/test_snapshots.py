"""Versions of tables that are published together."""

import pytest
from pyspark.sql import functions as F

from ordermart.sources import snapshots
from ordermart.sources.snapshots import drop_old, open_snapshot, publish_snapshot, versions


def tables(spark, n):
    return {"dm_one": spark.range(n), "Agg_two": spark.range(2 * n).withColumn("v", F.lit(n)), "none": spark.range(0)}


def counts(snapshot):
    return {n: snapshot.read(n).count() for n in snapshot.names()}


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    place = str(tmp_path / "store")
    assert open_snapshot(spark, place) is None and versions(spark, place) == []
    first = publish_snapshot(spark, tables(spark, 3), place)
    reader = open_snapshot(spark, place)
    second = publish_snapshot(spark, {"dm_one": spark.range(5), "new": spark.range(1)}, place)
    assert counts(first) == counts(reader) == {"dm_one": 3, "Agg_two": 6, "none": 0}
    assert counts(open_snapshot(spark, place)) == counts(second) == {"dm_one": 5, "new": 1}
    assert reader.names("agg_*") == ["Agg_two"] and reader.read("AGG_TWO").schema == first.read("Agg_two").schema
    assert second.read("Agg_two") is None


@pytest.mark.parametrize("step", ["table", "before pointer", "pointer"])
def test_a_crash_between_two_steps_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    place = str(tmp_path / "store")
    publish_snapshot(spark, tables(spark, 3), place)
    broken = tables(spark, 4)
    if step == "table":
        broken["dm_one"] = spark.range(4).select(F.raise_error(F.lit("broken")).alias("id"))
    elif step == "before pointer":
        monkeypatch.setattr(snapshots, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("broken")))
    else:
        real = snapshots._path

        def path(spark, name):
            if name.endswith(snapshots.POINTER) and crash:
                raise RuntimeError("broken")
            return real(spark, name)

        crash = []
        monkeypatch.setattr(snapshots, "_path", path)
        crash.append(1)
        monkeypatch.setattr(snapshots, "delete_path", lambda *a: None)
    with pytest.raises(Exception, match="broken"):
        publish_snapshot(spark, broken, place)
    monkeypatch.undo()
    assert counts(open_snapshot(spark, place)) == {"dm_one": 3, "Agg_two": 6, "none": 0}
    assert counts(publish_snapshot(spark, tables(spark, 5), place))["dm_one"] == 5
    if step == "pointer":
        # The process ended after the pointer was written and before it took its name: its version stays until it is cleared.
        assert len(versions(spark, place)) == 3


def test_old_versions_are_dropped_but_not_the_one_in_force(spark, tmp_path):
    place = str(tmp_path / "store")
    made = [publish_snapshot(spark, tables(spark, n), place) for n in (1, 2, 3)]
    drop_old(spark, place, keep=1)
    assert versions(spark, place) == [made[-1].version]
    assert counts(open_snapshot(spark, place)) == counts(made[-1])
    with pytest.raises(Exception):
        made[0].read("dm_one").count()
