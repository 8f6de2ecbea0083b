"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerstream.functions import eventtime, frames
from ledgerstream.functions.rules import AlertRules
from ledgerstream.operators import (alerts, balances, chains, correlation, envelope, history, profiles, router, routing,
                                    sessions)
from ledgerstream.operators.envelope import Writer
from ledgerstream.plans import sqljobs
from ledgerstream.session import configure, run_dir
from ledgerstream.sources import bank_events, files
from ledgerstream.streaming import jobs, late, live, replay, sinks, state, steps

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Where the parts of a stream that comes out of order begin, and the days of each.
PARTS_FROM_MS, PART_MS = 1_704_067_200_000, 5 * 86_400_000

# Rules under which the events table shows all three levels.
SCALED_WINDOW, SCALED_RULES = "1 day", AlertRules(max_count=4, max_amount=300.0)
MINUTE_RULES = AlertRules(max_count=1, max_amount=150.0)
TYPE_RULES = AlertRules(max_count=6, max_amount=400.0, watched_types=(2, 4), max_watched=1)

WRITERS = {bank_events.BANK_EVENT_ID: Writer("BankEvent"),
           bank_events.TRANSACTION_ID: Writer("Transaction"),
           bank_events.FRAUD_REPORT_ID: Writer("FraudReport")}
OUTPUTS = router.Outputs(bank_events.TRANSACTION_ID, bank_events.FRAUD_REPORT_ID, dead_letter_topic="dead-letters")


def _register(query: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    QUERIES[query.__name__] = configured
    return configured


def _cents(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Round sums of doubles, whose last digits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_events.transactions(bank_events.events(spark, sf_dir))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_events.fraud_reports(bank_events.events(spark, sf_dir))


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_events.corrupted_envelopes(bank_events.events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_events.corrupted_messages(bank_events.events(spark, sf_dir))


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_events.transactions(bank_events.events_stream(spark, sf_dir))


def _read_back(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """What a stream of ``rows`` wrote, also where that is nothing."""
    return spark.read.schema(rows.schema).parquet(path)


def _finish(writer: DataStreamWriter, spark: SparkSession, name: str, folder: str) -> None:
    """Work off the whole table as a stream."""
    jobs.start(writer, spark, name, f"{folder}/checkpoint", available_now=True).awaitTermination()


# Routing

@_register
def route_transactions(spark, sf_dir):
    return routing.transactions(_envelopes(spark, sf_dir))


@_register
def route_fraud_reports(spark, sf_dir):
    return routing.fraud_reports(_envelopes(spark, sf_dir))


@_register
def route_rejects(spark, sf_dir):
    return routing.rejects(_envelopes(spark, sf_dir)).select("event_id", "reject_reason")


@_register
def route_counts(spark, sf_dir):
    return (routing.classify(_envelopes(spark, sf_dir))
            .groupBy("topic", "reject_reason").agg(F.count("*").alias("n")))


@_register
def route_stream(spark, sf_dir):
    """The router as one streaming query with a folder per topic."""
    out = run_dir(spark, "route_stream")
    envelopes = bank_events.corrupted_envelopes(bank_events.events_stream(spark, sf_dir))
    routed = routing.classify(envelopes)
    _finish(sinks.append_files(routed, f"{out}/topics", by=["topic"]), spark, "route_stream", out)
    return _read_back(spark, routed, f"{out}/topics").select(
        "event_id", "topic", "reject_reason", "metadata.event_type",
        F.coalesce("body.member0.account_id", "body.member1.account_id").alias("account_id"))


@_register
def event_time(spark, sf_dir):
    return _envelopes(spark, sf_dir).select("event_id", F.unix_millis(eventtime.envelope_time()).alias("ms"))


# Messages

@_register
def decode_counts(spark, sf_dir):
    return (envelope.decode(_messages(spark, sf_dir), WRITERS, codec="json")
            .groupBy("decode_error").agg(F.count("*").alias("n")))


@_register
def decode_events(spark, sf_dir):
    decoded = envelope.records(envelope.decode(_messages(spark, sf_dir), WRITERS, codec="json"))
    return decoded.select("metadata.event_type",
                          F.coalesce("body.member0.id", "body.member1.report_id").alias("id"),
                          F.coalesce("body.member0.timestamp", "body.member1.timestamp").alias("timestamp"))


@_register
def router_messages(spark, sf_dir):
    """Messages per topic and reason, from bytes to bytes."""
    routed = router.route_messages(_messages(spark, sf_dir), WRITERS, OUTPUTS, codec="json")
    return (routed.groupBy("topic", F.col("headers")[0]["value"].cast("string").alias("reason"))
            .agg(F.count("*").alias("n")))


@_register
def router_transactions(spark, sf_dir):
    """The transaction topic as its consumer reads it."""
    routed = router.route_messages(_messages(spark, sf_dir), WRITERS, OUTPUTS, codec="json")
    sent = routed.filter(F.col("topic") == OUTPUTS.transaction_topic)
    return envelope.records(envelope.decode(sent, WRITERS, "Transaction", "json", metrics="consume"))


@_register
def replayed_letters(spark, sf_dir):
    """Dead letters sent once their schema is known; the run before it and the one after it send nothing."""
    out = run_dir(spark, "replayed_letters")
    routed = router.route_messages(_messages(spark, sf_dir), WRITERS, OUTPUTS, codec="json")
    routed.filter(F.col("topic") == OUTPUTS.dead_letter_topic).write.parquet(f"{out}/letters")
    letters = spark.read.schema(routed.schema).parquet(f"{out}/letters")
    known = WRITERS | {bank_events.UNKNOWN_ID: Writer("BankEvent")}
    for writers in (WRITERS, known, known):
        replay.replay(spark, out, letters, writers, OUTPUTS, f"{out}/topics", "json")
    sent = replay.replayed_messages(spark, f"{out}/topics")

    def ids(topic: str, record: str, key: str) -> DataFrame:
        read = envelope.decode(sent.filter(F.col("topic") == topic), WRITERS, record, "json")
        return envelope.records(read).select(F.lit(topic).alias("topic"), F.col(key).alias("id"), "account_id")

    return ids(OUTPUTS.transaction_topic, "Transaction", "id").unionByName(
        ids(OUTPUTS.fraud_report_topic, "FraudReport", "report_id"))


@_register
def route_with_new_schemas(spark, sf_dir):
    """Messages in four batches; the schema of some of them is registered after the second."""
    out = run_dir(spark, "route_with_new_schemas")
    known = [(i, w.record, w.avro) for i, w in WRITERS.items()]
    spark.createDataFrame(known, live.SCHEMAS).coalesce(1).write.parquet(f"{out}/schemas")
    events = bank_events.events(spark, sf_dir)
    for half in (0, 1):
        for quarter in (2 * half, 2 * half + 1):
            part = bank_events.corrupted_messages(events.filter(F.col("event_id") % 4 == quarter))
            part.coalesce(1).write.mode("append").parquet(f"{out}/messages")
        messages = files.read_stream(spark, f"{out}/messages", "value binary", files_per_batch=1)
        _finish(live.route(messages, f"{out}/schemas", f"{out}/sent", OUTPUTS, "json"), spark, "route_with_new_schemas", out)
        late_one = spark.createDataFrame([(bank_events.UNKNOWN_ID, "BankEvent", "")], live.SCHEMAS)
        late_one.coalesce(1).write.mode("append").parquet(f"{out}/schemas")
    return live.sent(spark, f"{out}/sent").groupBy("topic").agg(F.count("*").alias("n"))


@_register
def route_to_two_sinks(spark, sf_dir):
    """Topics and a table of rejects by one query, each batch once into each."""
    out = run_dir(spark, "route_to_two_sinks")
    routed = routing.classify(bank_events.corrupted_envelopes(bank_events.events_stream(spark, sf_dir)))

    def rejects(batch: DataFrame, batch_id: int) -> None:
        steps.files(f"{out}/rejects")(batch.filter("reject_reason is not null"), batch_id)

    writer = steps.write_in_turn(routed, f"{out}/ledger", {"topics": steps.files(f"{out}/topics"), "rejects": rejects})
    _finish(writer, spark, "route_to_two_sinks", out)
    topics, kept = (_read_back(spark, routed, f"{out}/{sink}") for sink in ("topics", "rejects"))
    return (topics.select(F.lit("topics").alias("sink"), "event_id", "topic", "reject_reason")
            .unionByName(kept.select(F.lit("rejects").alias("sink"), "event_id", "topic", "reject_reason")))


# Balances

@_register
def account_balances(spark, sf_dir):
    return _cents(balances.account_balances(_transactions(spark, sf_dir)), "total_balance")


@_register
def account_balances_stream(spark, sf_dir):
    out = run_dir(spark, "account_balances_stream")
    changes = balances.account_balances(_streamed(spark, sf_dir))
    _finish(sinks.upsert_files(changes, f"{out}/table", ["account_id"]), spark, "account_balances_stream", out)
    return _cents(sinks.read_upserts(spark, f"{out}/table", ["account_id"]), "total_balance")


def _source_view(transactions: DataFrame) -> str:
    name = f"source_{uuid.uuid4().hex}"
    transactions.createOrReplaceTempView(name)
    return name


def _drop_views(spark: SparkSession, properties: dict[str, str]) -> None:
    for view in ("transactions", properties["balance.source.view"]):
        spark.catalog.dropTempView(view)


@_register
def account_balances_sql(spark, sf_dir):
    out = run_dir(spark, "account_balances_sql")
    properties = {
        "sql.job.name": "Balance Aggregation Job",
        "sql.files": "balance/01_source_transactions.sql, balance/02_sink_balances.sql, "
                     "balance/03_logic_aggregation.sql",
        "balance.source.view": _source_view(_transactions(spark, sf_dir)),
        "balance.sink.table": f"balances_{uuid.uuid4().hex}",
        "balance.sink.path": f"{out}/table",
    }
    sqljobs.run(spark, properties)
    spark.sql(f"DROP TABLE {properties['balance.sink.table']}")  # the files stay
    _drop_views(spark, properties)
    return _cents(spark.read.parquet(properties["balance.sink.path"]), "total_balance")


@_register
def account_balances_sql_stream(spark, sf_dir):
    out, unique = run_dir(spark, "account_balances_sql_stream"), uuid.uuid4().hex
    properties = {
        "sql.job.name": "Balance Aggregation Stream",
        "sql.files": "events_stream/01_source_events.sql, events_stream/02_transactions.sql, "
                     "balance_stream/03_sink_balances.sql, balance_stream/04_logic_aggregation.sql",
        "balance.source.table": f"events_{unique}",
        "balance.source.format": "parquet",
        "balance.source.files.per.batch": str(files.PER_BATCH),
        "balance.source.path": f"{sf_dir}/events.parquet*",  # the glob serves a file as well as a folder
        "balance.source.view": f"transactions_{unique}",
        "balance.sink.table": f"balances_{unique}",
        "balance.sink.path": f"{out}/table",
    }
    sqljobs.start(spark, properties, checkpoint=f"{out}/checkpoint", available_now=True).awaitTermination()
    spark.catalog.dropTempView(properties["balance.source.view"])
    for table in ("balance.source.table", "balance.sink.table"):
        spark.sql(f"DROP TABLE {properties[table]}")  # the files stay
    return _cents(sinks.read_upserts(spark, f"{out}/table", ["account_id"]), "total_balance")


@_register
def account_balance_messages(spark, sf_dir):
    """The upsert topic, read back: framed key, framed value."""
    sent = envelope.balance_messages(balances.account_balances(_transactions(spark, sf_dir)), 4, 5, "json")

    def field(column: str, name: str):
        return F.get_json_object(frames.payload(column).cast("string"), f"$.{name}")

    return sent.select(frames.schema_id("key").alias("key_schema"),
                       frames.schema_id("value").alias("value_schema"),
                       field("key", "account_id").alias("account_id"),
                       F.round(field("value", "total_balance").cast("double"), 2).alias("total_balance"))


@_register
def account_balances_backfilled(spark, sf_dir):
    """The first half of the month as a batch, the rest as a stream behind it, by one stateful query."""
    out, cut = run_dir(spark, "account_balances_backfilled"), F.lit("2024-01-16").cast("timestamp_ntz")
    opened = balances.opening(bank_events.transactions(bank_events.events(spark, sf_dir).filter(F.col("ts") < cut)))
    opened.write.parquet(f"{out}/opening")
    live = bank_events.transactions(bank_events.events_stream(spark, sf_dir).filter(~(F.col("ts") < cut)))
    changes = balances.continued(files.read_stream(spark, f"{out}/opening", opened.schema), live)
    _finish(sinks.upsert_files(changes, f"{out}/table", ["account_id"]), spark, "account_balances_backfilled", out)
    return _cents(sinks.read_upserts(spark, f"{out}/table", ["account_id"]), "total_balance")


@_register
def account_balances_state(spark, sf_dir):
    """The balances as the streaming query holds them, read from its checkpoint and not from its sink."""
    out = run_dir(spark, "account_balances_state")
    changes = balances.account_balances(_streamed(spark, sf_dir))
    _finish(sinks.upsert_files(changes, f"{out}/table", ["account_id"]), spark, "account_balances_state", out)
    return _cents(state.balances(spark, f"{out}/checkpoint"), "total_balance")


@_register
def account_history(spark, sf_dir):
    return _cents(_cents(balances.account_history(_transactions(spark, sf_dir)), "total_amount"),
                  "avg_amount", "stddev_amount", digits=9)


@_register
def account_profiles(spark, sf_dir):
    """Profiles over ten days, from daily sketches that are written and read again."""
    out = run_dir(spark, "account_profiles")
    daily = profiles.daily_profiles(_transactions(spark, sf_dir))
    daily.write.parquet(f"{out}/daily")
    found = profiles.profiles(spark.read.schema(daily.schema).parquet(f"{out}/daily"), "2024-01-08", "2024-01-18")
    return _cents(found.select("account_id", "transaction_count", "total_amount", "min_amount", "max_amount"), "total_amount")


# Alerts

@_register
def fraud_windows(spark, sf_dir):
    return _cents(alerts.account_windows(_transactions(spark, sf_dir)), "total_amount")


@_register
def fraud_alerts(spark, sf_dir):
    return _cents(alerts.alerts(bank_events.order_transactions(spark, sf_dir)), "total_amount")


@_register
def fraud_alerts_one_minute(spark, sf_dir):
    return _cents(alerts.alerts(_transactions(spark, sf_dir), "1 minute", MINUTE_RULES), "total_amount")


@_register
def fraud_alerts_scaled(spark, sf_dir):
    return _cents(alerts.alerts(_transactions(spark, sf_dir), SCALED_WINDOW, SCALED_RULES), "total_amount")


@_register
def fraud_alerts_by_type(spark, sf_dir):
    return _cents(alerts.alerts(_transactions(spark, sf_dir), SCALED_WINDOW, TYPE_RULES), "total_amount")


@_register
def fraud_alerts_stream(spark, sf_dir):
    """Streamed alerts; windows the watermark has not passed stay open."""
    out = run_dir(spark, "fraud_alerts_stream")
    found = alerts.alerts(_streamed(spark, sf_dir), SCALED_WINDOW, SCALED_RULES)
    _finish(sinks.append_files(found, f"{out}/alerts"), spark, "fraud_alerts_stream", out)
    return _cents(_read_back(spark, found, f"{out}/alerts"), "total_amount")


@_register
def fraud_alerts_early(spark, sf_dir):
    """Alerts as they stand, windows that are still open too, from a keyed sink in update mode."""
    out, keys = run_dir(spark, "fraud_alerts_early"), ["account_id", "window_start"]
    changes = alerts.window_changes(_streamed(spark, sf_dir), SCALED_WINDOW, SCALED_RULES)
    _finish(sinks.upsert_files(changes, f"{out}/windows", keys), spark, "fraud_alerts_early", out)
    return _cents(alerts.standing(sinks.read_upserts(spark, f"{out}/windows", keys)), "total_amount")


@_register
def alerts_with_last_report(spark, sf_dir):
    found = alerts.alerts(_transactions(spark, sf_dir), SCALED_WINDOW, SCALED_RULES)
    held = history.with_last_report(found, _reports(spark, sf_dir), "window_end")
    return held.select("account_id", "window_start", "urgency_level", "last_report_id", "last_risk_level", "last_reported_at")


@_register
def unusual_amounts(spark, sf_dir):
    return _cents(history.unusual_amounts(_transactions(spark, sf_dir)), "usual", "spread", digits=6)


def _in_overlapping_parts(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The events as files of a stream, each reaching back over two thirds of the one before it."""
    events = bank_events.events(spark, sf_dir)
    since = F.unix_millis(F.col("ts").cast("timestamp")) - F.lit(PARTS_FROM_MS)
    parted = events.withColumn("part", F.floor(since / PART_MS) + F.col("event_id") % 3)
    for (part,) in parted.select("part").distinct().orderBy("part").collect():  # one row for five days of events
        parted.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)


@_register
def late_transactions(spark, sf_dir):
    """Every transaction once, with the micro-batch that met it and whether its window was closed by then."""
    out = run_dir(spark, "late_transactions")
    _in_overlapping_parts(spark, sf_dir, f"{out}/events")
    stream = bank_events.transactions(files.read_stream(spark, f"{out}/events", bank_events.EVENTS, files_per_batch=1))
    writer = late.split(stream, f"{out}/parts", f"{out}/checkpoint", "1 day", "2 days")
    _finish(writer, spark, "late_transactions", out)
    in_time, too_late = (read(spark, f"{out}/parts", stream.schema) for read in (late.accepted, late.late))
    return (in_time.withColumn("late", F.lit(False)).unionByName(too_late.withColumn("late", F.lit(True)))
            .select("id", "account_id", "batch_id", "late"))


# Bursts and correlation

@_register
def account_sessions(spark, sf_dir):
    return _cents(sessions.sessions(_transactions(spark, sf_dir)), "total_amount")


@_register
def account_sessions_stream(spark, sf_dir):
    out = run_dir(spark, "account_sessions_stream")
    found = sessions.sessions(_streamed(spark, sf_dir))
    _finish(sinks.append_files(found, f"{out}/sessions"), spark, "account_sessions_stream", out)
    return _cents(_read_back(spark, found, f"{out}/sessions"), "total_amount")


def _naming_the_previous_event(reports: DataFrame) -> DataFrame:
    # A derived report names its own event, which is never a transaction.
    return reports.withColumn("transaction_id", (F.col("transaction_id").cast("long") - 1).cast("string"))


@_register
def reported_transactions(spark, sf_dir):
    return correlation.reported_transactions(_naming_the_previous_event(_reports(spark, sf_dir)),
                                             _transactions(spark, sf_dir))


@_register
def reported_transactions_stream(spark, sf_dir):
    out = run_dir(spark, "reported_transactions_stream")
    reports = bank_events.fraud_reports(bank_events.events_stream(spark, sf_dir))
    found = correlation.reported_transactions_stream(_naming_the_previous_event(reports), _streamed(spark, sf_dir))
    _finish(sinks.append_files(found, f"{out}/found"), spark, "reported_transactions_stream", out)
    return _read_back(spark, found, f"{out}/found")


@_register
def activity_before_report(spark, sf_dir):
    return _cents(correlation.activity_before(_reports(spark, sf_dir), _transactions(spark, sf_dir)),
                  "total_amount")


@_register
def activity_before_report_stream(spark, sf_dir):
    out = run_dir(spark, "activity_before_report_stream")
    reports = bank_events.fraud_reports(bank_events.events_stream(spark, sf_dir))
    found = correlation.activity_before_stream(reports, _streamed(spark, sf_dir))
    _finish(sinks.append_files(found, f"{out}/found"), spark, "activity_before_report_stream", out)
    return _cents(_read_back(spark, found, f"{out}/found"), "total_amount")


@_register
def fraud_chains(spark, sf_dir):
    return chains.fraud_chains(_reports(spark, sf_dir))
