import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotbook.operators import surrogate
from lotbook.operators.surrogate import assign_surrogate, number_small
from tests.conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(5000).select(
        F.md5(F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") % 10 < 7, F.lit("big")).when(F.col("id") % 10 < 9, F.lit("mid")).otherwise(F.lit("small"))
        .alias("kind"),
    )


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equals_a_global_row_number(frame, no_coalescing):
    numbered = assign_surrogate(frame, "n", ["key"], start=11)
    assert numbered.total == 5000
    expected = frame.select("key", "kind", (F.row_number().over(Window.orderBy("key")) + 10).alias("n"))
    assert rows(numbered.rows, "key", "kind", "n") == rows(expected)


def test_group_numbers_span_partitions(frame, no_coalescing):
    numbered = assign_surrogate(frame, "n", ["key"], start=2, within=["kind"])
    assert numbered.counts == {("big",): 3500, ("mid",): 1000, ("small",): 500}
    over = Window.partitionBy("kind").orderBy("key")
    expected = frame.select("key", "kind", (F.row_number().over(over) + 1).alias("n"))
    assert rows(numbered.rows, "key", "kind", "n") == rows(expected)


def test_coalesced_partitions_keep_the_order(frame):
    numbered = assign_surrogate(frame, "n", ["key"])
    in_order = [r.key for r in numbered.rows.orderBy("n").select("key").collect()]
    assert in_order == sorted(in_order)


def test_known_small_frames_take_one_task(frame):
    numbered = assign_surrogate(frame, "n", ["key"], within=["kind"], known_rows=5000)
    assert numbered.counts[("mid",)] == 1000
    direct = number_small(frame, "n", ["key"], 5)
    assert direct.rdd.getNumPartitions() == 1
    assert [r.n for r in direct.orderBy("key").collect()] == list(range(5, 5005))


def test_nothing_to_number(frame):
    numbered = assign_surrogate(frame.filter("key = ''"), "n", ["key"], within=["kind"])
    assert numbered.total == 0 and numbered.rows.columns == ["key", "kind", "n"] and numbered.rows.count() == 0


def test_ids_do_not_change_when_read_again(frame):
    numbered = assign_surrogate(frame, "n", ["key"]).rows
    assert rows(numbered) == rows(numbered.repartition(7))


def test_costly_rows_are_worked_out_once(spark, monkeypatch):
    """Numbering by range samples written rows, so a row of the input is made a single time."""
    monkeypatch.setattr(surrogate, "ONE_TASK_ROWS", 10)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    numbered = assign_surrogate(spark.range(500).mapInArrow(count, "id long"), "n", ["id"], once=True)
    assert sorted(tuple(r) for r in numbered.rows.select("id", "n").collect()) == [(i, i + 1) for i in range(500)]
    assert made.value == 500 and numbered.total == 500


def test_equal_rows_are_numbered_as_one_without_another_shuffle(frame, monkeypatch):
    monkeypatch.setattr(surrogate, "ONE_TASK_ROWS", 10)
    plans, save = [], surrogate.save

    def kept(rows, label, *options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return save(rows, label, *options)

    monkeypatch.setattr(surrogate, "save", kept)
    twice = frame.union(frame.filter("kind = 'mid'"))
    numbered = assign_surrogate(twice, "n", ["key"], start=5, once=True, distinct=True, lean=True)
    assert numbered.total == 5000 and plans[0].count("Exchange ") == 1 and "rangepartitioning" in plans[0]
    expected = frame.select("key", "kind", (F.row_number().over(Window.orderBy("key")) + 4).alias("n"))
    assert rows(numbered.rows, "key", "kind", "n") == rows(expected)
