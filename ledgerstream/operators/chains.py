"""Accounts that fraud reports tie together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstream.session import run_dir


def fraud_chains(reports: DataFrame) -> DataFrame:
    """Each reported account with the smallest account that chains reach from it, and how many they reach (batch).

    Accounts that share a chain belong together, and so do those that a third account ties to both. Accounts and
    chains form a two-sided graph; chains never become pairs of accounts, so a chain with very many accounts costs
    its rows. Each round hooks every group of accounts to the smallest group next to it, follows the hooks to their
    ends, and gives the accounts' groups to the chains again. A group that hooks nowhere has neighbours that hook to
    a smaller one, so the groups fall away by halves and the rounds grow with the logarithm of a group's width.

    Accounts stand in string order. A report without an account is left out; one without a chain ties nothing. Every
    round is written under the shared folder; the result reads the last one.
    """
    spark, folder = reports.sparkSession, run_dir(reports.sparkSession, "fraud_chains")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    ties = reports.filter("account_id is not null").select("account_id", "fraud_chain_id").distinct()
    groups = written(ties.select("account_id", F.col("account_id").alias("group_id")).distinct(), "groups-0")
    edges = written(ties.filter("fraud_chain_id is not null")
                    .select(F.col("account_id").alias("group_id"), "fraud_chain_id"), "edges-0")
    turn = 0
    while True:
        turn += 1
        smallest = edges.groupBy("fraud_chain_id").agg(F.min("group_id").alias("next"))
        hooks = written(edges.join(smallest, "fraud_chain_id").groupBy("group_id").agg(F.min("next").alias("next")),
                        f"hooks-{turn}")
        if hooks.filter("next < group_id").isEmpty():
            break
        hooks = _ends(hooks, lambda df, i: written(df, f"hooks-{turn}-{i}"))
        groups = written(_moved(groups, hooks), f"groups-{turn}")
        edges = written(_moved(edges, hooks).distinct(), f"edges-{turn}")
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("accounts"))
    return groups.join(sizes, "group_id").select("account_id", "group_id", "accounts")


def _ends(hooks: DataFrame, written) -> DataFrame:
    """Every group with the end of its chain of hooks: each turn doubles the steps taken."""
    i = 0
    while True:
        further = hooks.select(F.col("group_id").alias("next"), F.col("next").alias("end"))
        i += 1
        jumped = written(hooks.join(further, "next").select("group_id", F.col("end").alias("next"),
                                                            (F.col("end") != F.col("next")).alias("moved")), i)
        hooks = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return hooks


def _moved(rows: DataFrame, hooks: DataFrame) -> DataFrame:
    """``rows`` under the groups that theirs hooked to; groups without chains stay."""
    other = [c for c in rows.columns if c != "group_id"]
    return (rows.join(hooks, "group_id", "left")
            .select(*other, F.coalesce("next", "group_id").alias("group_id")))
