"""Rules and a classifier for URLs."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstream.llm.common import LOWER, UPPER

# Verdict and rule (host and start of the path).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/")]

# The labelled table: host and path of made-up sites, 1 for those to block.
LABELLED = [
    ("news.morning-post.example.org", "/world/2021/story.html", 0), ("www.riverside-school.example.net", "/en/lessons", 0),
    ("blog.gardenpath.example.com", "/2019/05/roses", 0), ("docs.softlib.example.org", "/guide/install.html", 0),
    ("wiki.historyclub.example.net", "/de/mittelalter", 0), ("m.weather-today.example.com", "/city/12", 0),
    ("www.cityhall.example.org", "/services/parking", 0), ("recipes.kitchen.example.com", "/fr/soupe", 0),
    ("shop.bookstore.example.net", "/item/483", 0), ("forum.cyclists.example.org", "/thread/77?page=2", 0),
    ("www.tanderen.example.com", "/en/12", 0), ("m.helione.example.org", "/de/845.html", 0),
    ("thersand.example.net", "/fr/90", 0), ("blog.ingthal.example.org", "/es/311.html", 0),
    ("oredanth.example.com", "/en/557/", 0), ("www.entrest.example.net", "/en/4", 0),
    ("lab.university.example.org", "/research/papers/17", 0), ("health.clinic.example.com", "/advice/sleep", 0),
    ("museum.arts.example.net", "/collection/2", 0), ("www.musicroom.example.org", "/lessons/piano", 0),
    ("travel.islands.example.com", "/es/playa", 0), ("m.trainlines.example.net", "/timetable", 0),
    ("www.statistics.example.org", "/tables/2020", 0), ("poems.reading.example.com", "/en/spring", 0),
    ("casino-royal.example.com", "/en/bonus", 1), ("www.casino-jackpot.example.org", "/slots/1", 1),
    ("m.win-casino.example.net", "/de/spins", 1), ("best-casino-win.example.org", "/en/77", 1),
    ("free-bets-now.example.com", "/en/odds", 1), ("www.sport-bets.example.net", "/fr/free-bets", 1),
    ("bets-online.example.org", "/en/9", 1), ("poker-win.example.com", "/play", 1),
    ("cheap-pills.example.org", "/order", 1), ("www.pills-shop.example.com", "/en/cheap", 1),
    ("buy-viagra.example.net", "/pills/3", 1), ("m.cheap-meds.example.org", "/es/pills", 1),
    ("adult-videos.example.com", "/xxx/5", 1), ("www.adult-x.example.org", "/en/adult", 1),
    ("hot-porn.example.net", "/xxx", 1), ("sex-cams.example.org", "/adult/live", 1),
    ("spam-links.example.com", "/farm/1", 1), ("www.link-farm.example.org", "/spam", 1),
    ("seo-spam-farm.example.net", "/en/links", 1), ("ads-server.example.com", "/track/click", 1),
    ("www.ads-click.example.org", "/banner/2", 1), ("track-ads.example.net", "/pixel", 1),
    ("m.ad-tracker.example.org", "/ads/track", 1), ("phishing-login.example.com", "/verify/account", 1),
]

SIZES = (3, 4, 5)
BUCKETS = 1 << 16


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What stands behind the host up to ``?``, ``#`` or end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What stands behind the first ``://``; empty for null and for a URL without it."""
    return F.coalesce(F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``verdict`` and ``rule``, or null."""
    found = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, start = rule.split("/", 1)
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + start)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the character n-grams of host and path, each marked with where it stands."""
    found = set()
    for mark, part in (("h", host), ("p", path)):
        data = f"^{part}$"
        found |= {zlib.crc32((mark + data[i:i + n]).encode("utf-8", "replace")) % BUCKETS
                  for n in SIZES for i in range(len(data) - n + 1)}
    return np.fromiter(sorted(found), np.int64)


def train(rows: Sequence[tuple[str, str, int]] = LABELLED, prior: float = 0.1, penalty: float = 2e-5, steps: int = 3000,
          rate: float = 4.0) -> np.ndarray:
    """Weights of a logistic regression (the last is the intercept), by gradient descent over all rows.

    ``prior`` is the part of URLs to block that is taken to hold for unseen ones: the rows are weighted to it, so that
    a URL without evidence is allowed.
    """
    design = np.zeros((len(rows), BUCKETS + 1))
    for row, (host, path, _) in zip(design, rows):
        held = features(host, path)
        row[held] = 1 / np.sqrt(max(len(held), 1))
        row[-1] = 1
    labels, weights = np.array([r[2] for r in rows], float), np.zeros(BUCKETS + 1)
    share = np.where(labels == 1, prior / max(labels.sum(), 1), (1 - prior) / max((1 - labels).sum(), 1))
    used = np.flatnonzero(design.any(0))
    design, found = design[:, used], np.zeros(len(used))
    for _ in range(steps):
        wrong = share * (1 / (1 + np.exp(-design @ found)) - labels)
        found -= rate * (design.T @ wrong + penalty * np.where(used == BUCKETS, 0, found))
    weights[used] = found
    return weights


def probability(host: Column, path: Column, weights: np.ndarray) -> Column:
    """The probability that a URL is to be blocked."""
    kept = np.flatnonzero(weights[:-1])
    held, bias = dict(zip(kept.tolist(), weights[kept].tolist())), float(weights[-1])

    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        dense = np.zeros(BUCKETS)
        dense[list(held)] = list(held.values())
        for hosts, paths in batches:
            sums = [dense[f].sum() / np.sqrt(max(len(f), 1)) for f in map(features, hosts, paths)]
            yield pd.Series(1 / (1 + np.exp(-(np.array(sums, float) + bias))))

    return of(host, path)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: Sequence[tuple[str, str, int]] = LABELLED,
          id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` (null: none fits), ``verdict`` and ``probability`` for each row.

    A rule fits its host and all subdomains if the path starts as the rule's; the longest rule that fits decides. Where
    none fits, the classifier does: a logistic regression on hashed character n-grams (3 to 5) of host and path, learned
    from the small labelled table; a URL is blocked from a probability of ``threshold`` on. A null URL, or one without
    ``://``, has an empty host and path, which no rule fits. Each row is judged by itself, repeated rows alike.
    """
    split = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"))
    found = split.select(id_col, "_host", "_path", rule_of(F.col("_host"), F.col("_path"), rules).alias("_rule"),
                         probability(F.col("_host"), F.col("_path"), train(labelled)).alias("_p"))
    return found.select(
        id_col, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_p") >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.col("_p").alias("probability"))
