"""URL filter: host and path rules, and a learned classifier for all other URLs.

The classifier is a logistic regression on hashed character n-grams of the host
and of the path. It is trained on a small table of labelled URLs on the driver;
the table's size is bounded by ``MAX_LABELLED``, the model's by ``BUCKETS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ascii_lower, spare

BUCKETS = 2**15
SIZES = (3, 4, 5)
#: Rows of the labelled table, at most.
MAX_LABELLED = 10_000

#: Invented URLs, 1 for those to block.
LABELLED_URLS = [
    ("http://casino-royal.example.com/en/1", 1), ("https://www.casino-win.example.org/de/22", 1),
    ("https://m.online-casino.example.net/fr/303", 1), ("http://best-casino.example.com/play", 1),
    ("http://free-bets.example.org/en/17", 1), ("https://www.sports-bets.example.com/es/5.html", 1),
    ("https://bets-now.example.net/en/31/", 1), ("http://blog.free-bets.example.net/fr/88?page=2", 1),
    ("http://cheap-pills.example.org/en/6", 1), ("https://www.pills-online.example.net/de/71", 1),
    ("https://m.cheap-pills.example.net/fr/9.html", 1), ("http://cheap-meds.example.com/en/404/", 1),
    ("http://ads-track.example.net/en/52", 1), ("https://www.ads-server.example.org/de/3", 1),
    ("https://m.track-ads.example.com/en/81", 1), ("http://click-ads.example.org/es/14?ref=x", 1),
    ("http://poker-slots.example.com/en/7", 1), ("https://win-jackpot.example.net/de/66", 1),
    ("https://free-slots.example.org/en/12/", 1), ("http://www.lucky-win.example.com/fr/4", 1),
    ("http://payday-loans.example.net/en/18", 1), ("https://cheap-loans.example.com/de/29.html", 1),
    ("http://xxx-cams.example.org/en/3", 1), ("https://www.hot-xxx.example.net/es/45", 1),
    ("http://replica-watches.example.com/en/23", 1), ("https://cheap-viagra.example.org/de/6", 1),
    ("http://free-porn.example.net/en/11", 1), ("https://www.porn-tube.example.com/fr/90", 1),
    ("http://spam-links.example.com/en/15", 1), ("https://www.link-farm.example.net/fr/8", 1),
    ("https://news.example.org/en/2024/election.html", 0), ("http://www.library.example.net/de/81", 0),
    ("https://docs.example.com/en/guide/", 0), ("https://blog.gardens.example.org/fr/33", 0),
    ("http://m.weather.example.net/en/5#top", 0), ("https://museum.example.org/es/204.html", 0),
    ("https://www.theater.example.com/de/16?page=2&ref=x", 0), ("http://thenth.example.net/en/7121", 0),
    ("https://blog.thered.example.com/en/3020?utm_source=feed", 0), ("http://www.thonth.example.org/fr/911/", 0),
    ("https://m.reading.example.net/en/418.html", 0), ("http://tionth.example.com/de/2744#top", 0),
    ("https://www.erther.example.org/en/60", 0), ("http://whthan.example.net/fr/1804/", 0),
    ("https://m.inghat.example.com/en/5530?page=2&ref=x", 0), ("http://blog.estand.example.org/es/72", 0),
    ("https://ndther.example.net/en/390.html", 0), ("https://www.onther.example.com/de/8156", 0),
    ("http://m.thaned.example.org/en/47?utm_source=feed", 0), ("https://atheon.example.net/fr/6402", 0),
    ("http://school.example.org/en/9", 0), ("https://www.hospital.example.net/de/27.html", 0),
    ("https://recipes.example.com/en/soup/", 0), ("http://chess.example.org/fr/13", 0),
    ("https://m.travel.example.com/es/310", 0), ("http://www.history.example.net/en/1848", 0),
    ("https://blog.science.example.org/en/62#top", 0), ("http://music.example.com/de/5", 0),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for NULL or without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """What the longest rule that fits says, and its text; NULLs if none fits."""
    does = text = F.lit(None).cast("string")
    for action, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        does = F.when(fits, F.lit(action)).otherwise(does)
        text = F.when(fits, F.lit(of + start)).otherwise(text)
    return does, text


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams of host and path, told apart by a mark."""
    grams = {
        mark + padded[k : k + n]
        for mark, padded in (("h", f"^{host}$"), ("p", f"^{path}$"))
        for n in SIZES
        for k in range(len(padded) - n + 1)
    }
    return np.fromiter({zlib.crc32(g.encode()) % BUCKETS for g in grams}, np.int64)


def _python_parts(url: str) -> tuple[str, str]:
    _, sign, rest = url.partition("://")
    stop = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest)) if sign else 0
    path = rest[stop:] if sign else ""
    cut = next((k for k, c in enumerate(path) if c in "?#"), len(path))
    return (rest[:stop].lower() if sign else ""), path[:cut]


def fit(labelled: list[tuple[str, int]], steps: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> np.ndarray:
    """Weights by gradient descent; the last is the intercept. URLs without n-grams say nothing."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"at most {MAX_LABELLED} labelled URLs")
    weights = np.zeros(BUCKETS + 1)
    rows = [(features(*_python_parts(url)), label) for url, label in labelled]
    rows = [(np.append(f, BUCKETS), 1 / np.sqrt(len(f)), label) for f, label in rows if len(f)]
    for _ in range(steps if rows else 0):
        slope = ridge * weights
        for at, scale, label in rows:
            error = 1 / (1 + np.exp(-scale * weights[at].sum())) - label
            slope[at] += error * scale / len(rows)
        weights -= rate * len(rows) / 8 * slope
    return weights


def judge(pages: DataFrame, weights: np.ndarray, rules: list[tuple[str, str, str]], url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule (NULL: none fits), block_score and verdict.

    ``verdict`` is the longest fitting rule's, else block if the classifier's
    score exceeds the threshold. URLs that are NULL, empty or without ``://``
    have an empty host and path, which no n-gram speaks against: allow. Rows
    stay apart; own columns of these names are replaced.
    """
    names = ("host", "path", "rule", "verdict", "block_score")
    kept = [c for c in pages.columns if c.lower() not in names]
    raw = spare([*kept, *names], "_url")
    shared = pages.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = shared.value
        for hosts, paths in batches:
            out = np.zeros(len(hosts))
            for k, (h, p) in enumerate(zip(hosts, paths)):
                at = features(h, p) if h or p else []
                if len(at):
                    out[k] = 1 / (1 + np.exp(-(float(w[at].sum()) + float(w[BUCKETS])) / np.sqrt(len(at))))
            yield pd.Series(out)

    parts = pages.select(*kept, F.col(url).alias(raw))
    host, path = url_parts(F.col(raw))
    parts = parts.withColumns({"host": host, "path": path})
    does, text = matched_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": text, "block_score": score("host", "path")})
    learned = F.when(F.col("block_score") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce(does, learned)).drop(raw)

