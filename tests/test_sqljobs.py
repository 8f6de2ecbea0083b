import logging

import pytest

from helpers import rows, stream, write_file
from ledgerstream.operators import balances
from ledgerstream.plans import sqljobs
from ledgerstream.streaming import sinks

DATA = [("a", 10, 3), ("a", -4, 7), ("b", 2, 5)]


def files(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.sql").write_text(text, encoding="utf-8")


def test_fill_is_literal_and_keeps_unknown_keys(caplog):
    with caplog.at_level(logging.WARNING):
        assert sqljobs.fill("${a.b} ${x} ${a.b} $a", {"a.b": r"\1 $&"}) == r"\1 $& ${x} \1 $& $a"
    assert caplog.messages == ["unresolved placeholder: ${x}"]


def test_unknown_key_reaches_spark_unchanged(spark, tmp_path):
    files(tmp_path, one="SELECT '${nobody.knows}' AS v -- ünïcode")
    before = spark.conf.get("spark.sql.variable.substitute")
    assert sqljobs.run(spark, {"sql.files": "one.sql"}, tmp_path).first().v == "${nobody.knows}"
    assert spark.conf.get("spark.sql.variable.substitute") == before


def test_files_run_in_order_and_blanks_are_skipped(spark, tmp_path):
    files(tmp_path, b="CREATE OR REPLACE TEMPORARY VIEW seen AS SELECT ${n} AS n;",
          a="-- after b\nSELECT n + 1 AS n FROM seen;")
    assert sqljobs.run(spark, {"sql.files": " b.sql ,, a.sql ", "n": "41"}, tmp_path).first().n == 42


@pytest.mark.parametrize("listed", [{}, {"sql.files": "  "}])
def test_no_files(spark, listed):
    with pytest.raises(ValueError, match="sql.files"):
        sqljobs.run(spark, listed)


def test_a_list_of_blanks_runs_nothing_and_streams_nothing(spark):
    assert sqljobs.run(spark, {"sql.files": " , ,"}) is None
    with pytest.raises(ValueError, match="sql.files"):
        sqljobs.start(spark, {"sql.files": " , ,"})


def test_first_failure_stops_and_names_the_file(spark, tmp_path):
    files(tmp_path, bad="SELEC 1", never="CREATE OR REPLACE TEMPORARY VIEW never_made AS SELECT 1")
    with pytest.raises(sqljobs.SqlFileError, match="bad.sql"):
        sqljobs.run(spark, {"sql.files": "bad.sql,never.sql"}, tmp_path)
    assert not spark.catalog.tableExists("never_made")
    with pytest.raises(sqljobs.SqlFileError, match="gone.sql"):
        sqljobs.run(spark, {"sql.files": "gone.sql"}, tmp_path)


def test_balance_job_equals_the_operator(spark, transactions, tmp_path):
    transactions(DATA).createOrReplaceTempView("bank_transactions")
    sqljobs.run(spark, {
        "sql.files": "balance/01_source_transactions.sql,balance/02_sink_balances.sql,balance/03_logic_aggregation.sql",
        "balance.source.view": "bank_transactions", "balance.sink.table": "sql_balances",
        "balance.sink.path": f"{tmp_path}/out"})
    expected = rows(balances.account_balances(transactions(DATA)))
    assert rows(spark.table("sql_balances")) == expected
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == expected


def balance_job(tmp_path, n, **more):
    return {"sql.files": ", ".join(f"balance_stream/{f}.sql" for f in (
                "01_source_transactions", "02_transactions", "03_sink_balances", "04_logic_aggregation")),
            "balance.source.table": f"stored_{n}", "balance.source.format": "parquet", "balance.source.files.per.batch": "1",
            "balance.source.path": f"{tmp_path}/in", "balance.source.view": f"streamed_{n}", "balance.sink.table": f"sunk_{n}",
            "balance.sink.path": f"{tmp_path}/table", **more}


def test_streamed_balance_job_from_files_alone(spark, transactions, tmp_path):
    for row in DATA:
        write_file(transactions([row]), f"{tmp_path}/in")
    query = sqljobs.start(spark, balance_job(tmp_path, 1), checkpoint=f"{tmp_path}/checkpoint", available_now=True)
    query.awaitTermination()
    assert query.name == sqljobs.DEFAULT_NAME and len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows(sinks.read_upserts(spark, f"{tmp_path}/table", ["account_id"])) == rows(
        balances.account_balances(transactions(DATA)))


def test_streamed_select_into_a_sink(spark, transactions, tmp_path):
    write_file(transactions(DATA), f"{tmp_path}/in")
    stream(spark, f"{tmp_path}/in").createOrReplaceTempView("streamed_transactions")
    files(tmp_path, last="-- no insert\nSELECT account_id, SUM(amount_transferred) AS s FROM streamed_transactions GROUP BY account_id")
    query = sqljobs.start(spark, {"sql.files": "last.sql"}, lambda c: sinks.upsert_files(c, f"{tmp_path}/table", ["account_id"]),
                          tmp_path, f"{tmp_path}/checkpoint", True)
    query.awaitTermination()
    assert rows(sinks.read_upserts(spark, f"{tmp_path}/table", ["account_id"])) == [("a", 6.0), ("b", 2.0)]
    with pytest.raises(sqljobs.SqlFileError, match="last.sql"):
        sqljobs.start(spark, {"sql.files": "last.sql"}, base=tmp_path)


def test_streamed_insert_into_a_plain_table_appends(spark, transactions, tmp_path):
    write_file(transactions(DATA), f"{tmp_path}/in")
    stream(spark, f"{tmp_path}/in").createOrReplaceTempView("streamed_rows")
    files(tmp_path, sink=f"CREATE TABLE plain_sink (id STRING, account_id STRING) USING parquet LOCATION '{tmp_path}/plain'",
          last="INSERT INTO plain_sink SELECT id, account_id FROM streamed_rows")
    sqljobs.start(spark, {"sql.files": "sink.sql, last.sql"}, None, tmp_path, f"{tmp_path}/checkpoint", True).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/plain")) == [("0", "a"), ("1", "a"), ("2", "b")]
