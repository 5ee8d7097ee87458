"""Compaction of landed batches: each message once, before, between and after."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter

from roadflux.sources import raw
from roadflux.streaming import landing


def land(spark, lines, out, state):
    landing.land_stream(raw.text_stream(spark, lines), out, state, trigger=None).awaitTermination()


def files(path):
    return len([f for f in Path(path).rglob("part-*") if f.parent.name.split("=")[0] in ("zone", "batch")])


def test_compaction(spark, tmp_path):
    lines, out, store = (str(tmp_path / name) for name in ("lines", "landed", "compacted"))
    sent = []

    def send(state, n):
        made = [f'{{"zone": "Z{i % 2}", "event_time": "2024-01-0{1 + i % 3}T00:00:00", "vehicle_count": {n + 1}{i}}}' for i in range(12)]
        sent.extend(made)
        spark.createDataFrame([(m,) for m in made], "value string").coalesce(1).write.mode("append").text(lines)
        land(spark, lines, out, str(tmp_path / state))

    def got():
        return sorted(r.value for r in landing.landed(spark, out, store).collect())

    for n in range(4):
        send("a", n)
    assert got() == sorted(sent)
    held, loose = landing.landed(spark, out, store), files(out)
    assert landing.compact_landed(spark, out, store) == 0
    assert got() == sorted(sent) and sorted(r.value for r in held.collect()) == sorted(sent)
    assert files(store + "/parts") == 6 < loose * 3 // 4  # one a date and zone
    for n in range(4, 6):
        send("a", n)
    assert landing.compact_landed(spark, out, store) == 1
    assert got() == sorted(sent)
    assert files(out) == 6 * 3  # fold 0 is removed by now, fold 1 and the newest batch are there
    assert landing.compact_landed(spark, out, store) is None
    assert files(out) == 6 and got() == sorted(sent)
    # A folded batch that is landed again stays out.
    again = next(Path(out).rglob("batch=*"))
    first = again.parent / (again.name.rsplit("-", 1)[0] + "-0")
    first.mkdir()
    (first / "part-0.txt").write_text("again\n")
    assert got() == sorted(sent)
    # What a fold left unfinished does not count.
    (Path(store) / "folded" / "fold=2").mkdir()
    assert got() == sorted(sent)


def test_landing_does_not_sort_by_folder(spark, tmp_path):
    """The rows of a task would lie in memory for it. Rows come out alike when there are more folders than open files."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, text = spark.conf.get(setting), [], DataFrameWriter.text

    def recorded(self, *args, **kwargs):
        seen.append(int(spark.conf.get(setting)))
        return text(self, *args, **kwargs)

    lines = [f'{{"zone":"Z{k % 9}","event_time":"2024-01-{1 + k % 5:02d}T00:00:00"}}' for k in range(900)] + ["damaged"]
    messages = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    for writers in (landing.WRITERS, 3):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(DataFrameWriter, "text", recorded)
            patch.setattr(landing, "WRITERS", writers)
            landing.land_batch(messages, f"{tmp_path}/{writers}")
        got = spark.read.text(f"{tmp_path}/{writers}")
        assert sorted(r.value for r in got.select("value").collect()) == sorted(lines)
        assert got.select("date", "zone").distinct().count() == 46
    assert seen == [landing.WRITERS, 3] and spark.conf.get(setting) == before
