import os
import time

import pytest
from pyspark.sql import functions as F

from lotbook.sources.feeds import CANONICAL, OFFLINE, ONLINE, conform, csv_rejects, read_csv, stage
from lotbook.sources.inbox import Inbox
from lotbook.sources.scratch import CLEANUP, discard, new_folder, passing, save, save_counted, scratch_root
from tests import feeds
from tests.conftest import rows


def _line(**changes):
    cells = dict.fromkeys(OFFLINE.columns.values(), "x") | changes
    return ";".join(cells.values())


def test_csv_scan(spark, tmp_path):
    header = ";".join(name.title() for name in OFFLINE.columns.values())
    lines = [
        header,
        _line(id="1", customercity="", customername='"A ""B"" C"', cardelername="Runte, Wolff"),
        _line(id="2", customercity='""', customername='"semi;colon"', customerstate="  padded "),
    ]
    path = tmp_path / "offline.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    found = rows(read_csv(spark, str(path), OFFLINE), "id", "customercity", "customername", "customerstate",
                 "cardelername")
    assert found == [("1", None, 'A "B" C', "x", "Runte, Wolff"), ("2", "", "semi;colon", "  padded ", "x")]


def test_csv_line_end_inside_quotes(spark, tmp_path):
    path = tmp_path / "offline.csv"
    path.write_text(";".join(OFFLINE.columns.values()) + "\n" + _line(id="1", customername='"two\nlines"') + "\n")
    assert rows(read_csv(spark, str(path), OFFLINE, multi_line=True), "customername") == [("two\nlines",)]


def test_staging_replaces_its_copy(spark):
    folder = new_folder(spark, "stage")
    stage(feeds.offline(spark, {}, {"id": "101"}), folder)
    again = stage(feeds.offline(spark, {}), folder)
    assert again.count() == 1
    assert again.columns == list(OFFLINE.columns.values())


def test_conform_gives_both_feeds_one_shape(spark):
    left = conform(feeds.offline(spark, {"date": " 2022-01-01", "customercity": " Moss "}), OFFLINE)
    right = conform(feeds.online(spark, {}), ONLINE)
    assert left.columns == right.columns == [*CANONICAL, "source_system", "source_entity"]
    assert left.schema == right.schema or [f.dataType for f in left.schema] == [f.dataType for f in right.schema]
    row = left.first()
    assert (row.sale_date, row.city, row.income, row.reduction_percent) == (" 2022-01-01", "MOSS", None, None)
    row = right.first()
    assert (row.country, row.model, row.commission_rate, row.source_system) == (
        "NORWAY", "PANDA", None, "SA_CAR_SALES_ONLINE")


def test_scratch_uses_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    frame, count = save_counted(spark.range(7).toDF("n"), "t")
    assert count == 7 and frame.count() == 7
    assert all(scratch_root(spark) in f for f in frame.inputFiles())


def test_broken_records_are_put_aside(spark, tmp_path):
    path = tmp_path / "offline.csv"
    few, many = ";".join(["x"] * 5), ";".join(["x"] * 25)
    torn = _line(id="4", customername='"two\nlines"')
    last = _line(id="5", cardelername='"open')
    good = _line(id="6", customername='"semi;""colon"')
    path.write_text("\n".join([";".join(OFFLINE.columns.values()), _line(id="1"), few, "", many, torn, last, good]) + "\n")
    assert rows(read_csv(spark, str(path), OFFLINE), "id", "customername") == [("1", "x"), ("6", 'semi;"colon')]
    kinds = [r.problem for r in csv_rejects(spark, str(path), OFFLINE).collect()]
    assert sorted(kinds) == ["missing columns", "open quote", "open quote", "open quote", "surplus columns"]


def test_broken_records_of_a_multi_line_scan(spark, tmp_path):
    path = tmp_path / "offline.csv"
    few = ";".join(["x"] * 5)
    path.write_text("\n".join([";".join(OFFLINE.columns.values()), _line(id="4", customername='"two\nlines"'), few]) + "\n")
    assert rows(read_csv(spark, str(path), OFFLINE, multi_line=True), "id", "customername") == [("4", "two\nlines")]
    assert rows(csv_rejects(spark, str(path), OFFLINE, multi_line=True), "problem") == [("missing columns",)]


def _drop(folder, name, *lines):
    (folder / name).write_text("\n".join([";".join(OFFLINE.columns.values()), *lines]) + "\n")


def _numbered(number, *more):
    return ";".join([str(number), *["x"] * (len(OFFLINE.columns) - 1), *more])


def test_each_run_stages_new_files_only(spark, tmp_path):
    folder, staged = tmp_path / "inbox", str(tmp_path / "staged")
    folder.mkdir()
    inbox = Inbox(spark, str(folder), OFFLINE, staged)
    assert inbox.stage() == [] and inbox.waiting() == [] and inbox.rows().collect() == []
    _drop(folder, "a.csv", _numbered(1), _numbered(2), _numbered(3, "surplus"))
    _drop(folder, "b.csv", _numbered(4))
    assert len(inbox.stage()) == 1
    first = inbox.waiting()
    assert sorted(r["id"] for r in inbox.rows(first).collect()) == ["1", "2", "4"]
    assert [r["problem"] for r in inbox.rejects(first).collect()] == ["surplus columns"]
    # The load of the first batch is not reported yet: it waits, also for another object, beside the second one.
    _drop(folder, "c.csv", _numbered(5))
    again = Inbox(spark, str(folder), OFFLINE, staged)
    second = again.stage()
    assert len(second) == 1 and [r["id"] for r in again.rows(second).collect()] == ["5"]
    assert again.waiting() == [*first, *second]
    again.done(first)
    assert inbox.waiting() == second and inbox.rows().count() == 4
    inbox.done(second)
    assert again.waiting() == [] and again.stage() == []


def test_a_failed_run_stages_its_files_again(spark, tmp_path, monkeypatch):
    folder = tmp_path / "inbox"
    folder.mkdir()
    inbox = Inbox(spark, str(folder), OFFLINE, str(tmp_path / "staged"))
    _drop(folder, "a.csv", _numbered(1))
    with monkeypatch.context() as broken:
        broken.setattr(inbox, "_batch", lambda number: (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(Exception, match="no"):
            inbox.stage()
    assert inbox.waiting() == []
    assert len(inbox.stage()) == 1 and [r["id"] for r in inbox.rows(inbox.waiting()).collect()] == ["1"]


def test_compressed_drops_are_staged(spark):
    path, staged = new_folder(spark, "inbox"), new_folder(spark, "staged")
    inbox = Inbox(spark, path, OFFLINE, staged)
    for number in ("1", "2"):
        spark.createDataFrame([(_line(id=number),), ("broken",)], "value string").write.mode("append").option(
            "compression", "snappy").text(path)
        inbox.stage()
    assert rows(inbox.rows(), "id") == [("1",), ("2",)] and inbox.rejects().count() == 2


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_lean_saves_leave_no_shuffle_files_behind(spark):
    setting, before = spark.conf.get(CLEANUP), _shuffle_files(spark)
    kept, n = save_counted(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t", lean=True)
    for _ in range(50):  # they are removed in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    left = _shuffle_files(spark) - before
    assert not left and n == kept.count() == 7
    assert spark.conf.get(CLEANUP) == setting


def test_lean_saves_go_when_told_or_with_their_block(spark):
    def there(files):
        return [os.path.exists(f.removeprefix("file://")) for f in files]

    rows = spark.range(9)
    with passing(spark):
        outer = save(rows, "t", lean=True).inputFiles()
        with passing(spark):
            inner, other = save(rows, "t", lean=True).inputFiles(), save(rows, "t").inputFiles()
        assert all(there(outer)) and all(there(other)) and not any(there(inner))
    assert not any(there(outer))
    single = save(rows, "t", lean=True)
    files = single.inputFiles()
    assert all(there(files))
    discard(single)
    discard(single)
    assert not any(there(files))
