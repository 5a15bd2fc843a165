"""What a driver that dies leaves behind, and what the next start makes of it."""

import os
import subprocess
import sys
import textwrap

import pytest

from mentionflow.sources import journal as J, tables as T

SCHEMA = "date string, k string, v long"


class Died(BaseException):
    """The driver ends here: nothing catches it, nothing is cleaned up."""


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(spark, path):
    return sorted(tuple(r) for r in T.read_table(spark, path, frame(spark, []).schema).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    T.append_table(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "a", 3)]), path, ["date"])
    return path


NEW = [("2024-01-01", "n", 10), ("2024-01-02", "n", 20), ("2024-01-04", "n", 40)]
OLD_ROWS = [("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "a", 3)]
NEW_ROWS = sorted([*NEW, ("2024-01-03", "a", 3)])


def dies_after(monkeypatch, name, calls):
    """Let a step of the journal work so often and then end the driver."""
    real, left = getattr(J.Journal, name), [calls]

    def step(self, *args):
        if left[0] == 0:
            raise Died()
        left[0] -= 1
        return real(self, *args)

    monkeypatch.setattr(J.Journal, name, step)


@pytest.mark.parametrize("moves", range(0, 7))
def test_a_change_is_made_whole_or_not_at_all(spark, table, monkeypatch, moves):
    """The first move puts the entry in place, the others replace two partitions and add one."""
    with monkeypatch.context() as patch:
        dies_after(patch, "_move", moves)
        try:
            T.replace_partitions(frame(spark, NEW), table, ["date"])
            assert moves >= 6
        except Died:
            assert moves < 6
    done = T.recover(spark, table)
    assert rows_of(spark, table) == (OLD_ROWS if moves == 0 else NEW_ROWS)
    assert bool(done) == (0 < moves < 6)
    assert T.recover(spark, table) == []
    assert not any(os.listdir(f"{table}/{J.STAGED}"))
    T.replace_partitions(frame(spark, NEW), table, ["date"])
    assert rows_of(spark, table) == NEW_ROWS


def test_the_next_write_finishes_an_earlier_one_first(spark, table, monkeypatch):
    with monkeypatch.context() as patch:
        dies_after(patch, "_move", 2)
        with pytest.raises(Died):
            T.replace_partitions(frame(spark, NEW), table, ["date"])
    T.replace_partitions(frame(spark, [("2024-01-04", "z", 9)]), table, ["date"], [{"date": "2024-01-03"}])
    assert rows_of(spark, table) == sorted([("2024-01-01", "n", 10), ("2024-01-02", "n", 20), ("2024-01-04", "z", 9)])


def test_a_driver_that_dies_in_its_work_is_rolled_back(spark, table):
    def spoil(date):
        def work():
            T.replace_partitions(frame(spark, [(date, "x", 9)]), table, ["date"])
            raise Died()
        return work

    schema = frame(spark, []).schema
    closed = J.Journal.close_rollback
    for date in ("2024-01-02", "2024-01-09"):  # one that was there, one that was not
        J.Journal.close_rollback = lambda self, entry: None  # a dead driver closes nothing
        try:
            with pytest.raises(Died):
                T.with_rollback(spark, table, schema, {"date": date}, spoil(date))
        finally:
            J.Journal.close_rollback = closed
        assert ("x" in {r[1] for r in rows_of(spark, table)})
        assert T.recover(spark, table) == [f"rolled back date={date}"]
        assert rows_of(spark, table) == OLD_ROWS and T.recover(spark, table) == []


def test_a_killed_process_leaves_a_table_that_recovers(spark, table):
    """A real driver, ended between the removal of the old partition and the move of the new one."""
    script = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from mentionflow.session import build_session
        from mentionflow.sources import journal as J, tables as T
        spark = build_session("dies", "local[1]", 1, **{{"spark.checkpoint.dir": {table + "-scratch"!r}}})
        real, seen = J.Journal._move, []
        def move(self, source, target):
            if seen and "/{J.OLD}/" in seen[-1]:
                os._exit(9)
            real(self, source, target)
            seen.append(target)
        J.Journal._move = move
        T.replace_partitions(spark.createDataFrame([("2024-01-02", "n", 20)], {SCHEMA!r}), {table!r}, ["date"])
    """)
    ended = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=240)
    assert ended.returncode == 9
    assert ("2024-01-02", "a", 2) not in rows_of(spark, table)  # the partition is missing now
    assert len(T.recover(spark, table)) == 1
    assert rows_of(spark, table) == [("2024-01-01", "a", 1), ("2024-01-02", "n", 20), ("2024-01-03", "a", 3)]


def test_partitions_of_odd_names_and_two_columns(spark, tmp_path):
    path, schema = str(tmp_path / "two"), "d string, h int, v long"
    make = lambda rows: spark.createDataFrame(rows, schema)
    T.replace_partitions(make([("a=b/c", 1, 1), (None, 2, 2), ("x", 3, 3)]), path, ["d", "h"])
    T.replace_partitions(make([("a=b/c", 1, 9)]), path, ["d", "h"], [{"d": None, "h": 2}, {"d": "absent", "h": 1}])
    assert sorted(tuple(r) for r in T.read_table(spark, path, make([]).schema).collect()) == [("a=b/c", 1, 9), ("x", 3, 3)]
    T.drop_partitions(spark, path, [{"d": "x", "h": 3}], ["d", "h"])
    assert [tuple(r) for r in T.read_table(spark, path, make([]).schema).collect()] == [("a=b/c", 1, 9)]
