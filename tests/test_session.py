from pathlib import Path

from textgrain.session import durable, scratch


def place(table):
    return Path(table._durable_path.removeprefix("file:"))


def test_scratch_tables_go_and_kept_ones_stay(spark):
    outside = durable(spark.range(3))
    with scratch() as tables:
        gone = durable(spark.range(4))
        with scratch() as inner:
            passed_on = inner.keep(durable(gone.filter("id > 1")))
            lost = durable(gone)
        assert not place(lost).exists() and passed_on.count() == 2
        kept = tables.keep(durable(passed_on))
    assert not place(gone).exists() and not place(passed_on).exists()
    assert kept.count() == 2 and outside.count() == 3
