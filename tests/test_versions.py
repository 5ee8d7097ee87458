import pytest

from roadflux.sinks import versions


def table(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string, n int")


def content(frame):
    return sorted(tuple(r) for r in frame.collect())


def folders(spark, path, version=None):
    return versions.manifest(spark, path, version)["folders"]


def test_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(table(spark, [(k, "old", 0) for k in range(200)]), path, ["k"], buckets=16)
    before = folders(spark, path)
    assert len(before) == 16
    assert versions.merge(path, table(spark, [(3, "new", 1), (1000, "added", 1)])) == 1
    after = folders(spark, path)
    changed = [b for b in after if after[b] != before[b]]
    assert 1 <= len(changed) <= 2
    assert content(versions.read(spark, path)) == sorted([(k, "old", 0) for k in range(200) if k != 3] + [(3, "new", 1), (1000, "added", 1)])
    assert content(versions.read(spark, path, 0)) == [(k, "old", 0) for k in range(200)]
    assert versions.merge(path, table(spark, [])) == 1  # nothing to do, no version


def test_update_columns_and_order(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(table(spark, [(1, "a", 1), (2, "b", 2)]), path, ["k"], buckets=4)
    versions.merge(path, table(spark, [(1, "x", 9), (1, "y", 8), (3, "c", 3)]), update=["v"], order="n")
    assert content(versions.read(spark, path)) == [(1, "x", 1), (2, "b", 2), (3, "c", 3)]


def test_reader_is_not_disturbed_by_merge_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(table(spark, [(k, "old", 0) for k in range(50)]), path, ["k"], buckets=4)
    open_ = versions.read(spark, path)
    versions.merge(path, table(spark, [(k, "new", 1) for k in range(50)]))
    versions.vacuum(spark, path, keep=2)
    assert {r.v for r in open_.collect()} == {"old"}
    versions.merge(path, table(spark, [(0, "newer", 2)]))
    versions.vacuum(spark, path, keep=2)
    assert versions.versions(spark, path) == [1, 2]
    kept = {f for v in (1, 2) for f in folders(spark, path, v).values()}
    there = {f"{p.parent.parent.name}/{p.parent.name}/{p.name}" for p in (tmp_path / "t").glob("files/*/bucket=*")}
    assert there == kept
    assert content(versions.read(spark, path))[0] == (0, "newer", 2)


def test_of_two_writers_one_starts_again(spark, tmp_path, monkeypatch):
    path, write, calls = str(tmp_path / "t"), versions._write_buckets, []
    versions.create(table(spark, [(1, "a", 1), (2, "b", 1)]), path, ["k"], buckets=2)

    def slow(*args):
        made = write(*args)
        calls.append(args)
        if len(calls) == 1:  # the other writer is faster
            versions.merge(path, table(spark, [(1, "other", 2), (3, "other", 2)]))
        return made

    monkeypatch.setattr(versions, "_write_buckets", slow)
    assert versions.merge(path, table(spark, [(1, "mine", 3), (2, "mine", 3)])) == 2
    assert len(calls) == 3 and versions.versions(spark, path) == [0, 1, 2]
    assert content(versions.read(spark, path)) == [(1, "mine", 3), (2, "mine", 3), (3, "other", 2)]
    with pytest.raises(versions.Conflict):
        versions._commit(spark, path, 2, {})
    assert {p.name for p in (tmp_path / "t" / "versions").iterdir() if not p.name.endswith(".crc")} == {"0.json", "1.json", "2.json"}


def test_null_keys_and_clashing_name(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(table(spark, [(None, "a", 1), (1, "b", 1)]), path, ["k"], buckets=2)
    versions.merge(path, table(spark, [(None, "c", 2)]))
    assert sorted(map(str, versions.read(spark, path).collect())) == ["Row(k=1, v='b', n=1)", "Row(k=None, v='c', n=2)"]
    with pytest.raises(ValueError):
        versions.create(spark.createDataFrame([(1, 2)], "k int, bucket int"), str(tmp_path / "u"), ["k"])
