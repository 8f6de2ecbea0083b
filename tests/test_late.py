import pytest

from helpers import MINUTE, finish, rows, stream, write_file
from ledgerstream import schemas
from ledgerstream.operators import alerts
from ledgerstream.streaming import late, sinks

WINDOW, DELAY = "5 minutes", "10 seconds"
FILES = [[("a", 1, 1), ("a", 2, 2)], [("b", 5, 20)], [("b", 6, 21)], [("a", 100, 3)], [("b", 7, 40), ("a", 8, 39)], [("b", 8, 60)]]


def publish(transactions, path, files):
    for items in files:
        write_file(transactions([(a, x, m * MINUTE) for a, x, m in items]), f"{path}/in")


def split(spark, path):
    writer = late.split(stream(spark, f"{path}/in"), f"{path}/parts", f"{path}/checkpoint", WINDOW, DELAY)
    finish(writer, spark, "split", path)


def read(spark, path):
    return [rows(f(spark, f"{path}/parts", schemas.TRANSACTION), "account_id", "amount_transferred", "batch_id")
            for f in (late.accepted, late.late)]


def test_every_row_is_in_one_place(spark, transactions, tmp_path):
    path = str(tmp_path)
    publish(transactions, path, FILES)
    split(spark, path)
    accepted, too_late = read(spark, path)
    assert too_late == [("a", 100.0, 3)]
    assert sorted(r[:2] for r in accepted + too_late) == sorted((a, float(x)) for f in FILES for a, x, _ in f)


def test_accepted_rows_are_what_the_windows_count(spark, transactions, tmp_path):
    """The windowed query itself drops the late row; windows over what was accepted are the same."""
    path = str(tmp_path)
    publish(transactions, path, FILES)
    split(spark, path)
    windows = alerts.account_windows(stream(spark, f"{path}/in"), WINDOW, delay=DELAY)
    finish(sinks.append_files(windows, f"{path}/windows"), spark, "windows", f"{path}/w")
    columns = ("account_id", "transaction_count", "window_start")
    streamed = rows(spark.read.schema(windows.schema).parquet(f"{path}/windows"), *columns)
    batch = rows(alerts.account_windows(late.accepted(spark, f"{path}/parts", schemas.TRANSACTION), WINDOW, delay=DELAY), *columns)
    assert streamed and set(streamed) < set(batch)  # the last window is still open
    assert all(r[2] >= 60 * MINUTE for r in set(batch) - set(streamed))


def test_restart_between_and_inside_batches(spark, transactions, tmp_path, monkeypatch):
    path = str(tmp_path)
    publish(transactions, path, FILES[:3])
    split(spark, path)
    publish(transactions, path, FILES[3:])
    write = late.split_batch

    def dies(*args):
        def batch(df, batch_id):
            write(*args)(df, batch_id)
            if batch_id == 3:
                raise RuntimeError("after both folders were written")
        return batch

    monkeypatch.setattr(late, "split_batch", dies)
    with pytest.raises(Exception, match="after both folders"):
        split(spark, path)
    monkeypatch.undo()
    split(spark, path)
    accepted, too_late = read(spark, path)
    assert too_late == [("a", 100.0, 3)]
    assert sorted(r[:2] for r in accepted) == sorted((a, float(x)) for i, f in enumerate(FILES) if i != 3 for a, x, _ in f)


def test_rows_without_time_are_accepted(spark, transactions, tmp_path):
    path = str(tmp_path)
    publish(transactions, path, FILES[1:3])
    write_file(transactions([("n", 1, 0)]).selectExpr("id", "transaction_type_id", "account_id", "bank_id", "amount_transferred",
                                                      "reason", "cast(null as bigint) as timestamp"), f"{path}/in")
    split(spark, path)
    assert ("n", 1.0, 2) in read(spark, path)[0]
