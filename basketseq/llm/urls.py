"""URL filter: host and path rules, and a learned verdict for the rest.

Rules allow or block a host with all its subdomains below a path prefix; the
longest rule that fits decides. Where none fits, logistic regression on hashed
character n-grams of host and path does. It is trained on the driver from a
small table of labelled URLs (a parameter of at most ``MAX_LABELLED`` rows, by
default ``LABELLED``); the weights, ``2**BITS`` floats whatever the data, go to
the tasks, which score their rows in batches. Nothing is shuffled.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end.

Defined results: a null URL and one without ``://`` have an empty host and path,
fit no rule, have no n-grams, and get the model's verdict of the bias alone
(bounded to allow: nothing speaks against them). Repeated rows get equal
verdicts. Whole URLs are scored, whatever their length. Other columns do not
clash, since the input is taken as one struct.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Training table: URL and whether to block it.
LABELLED = tuple(
    (f"{scheme}{host}{path}", blocked)
    for blocked, hosts in (
        (
            True,
            (
                "m.ads-track.example.com",
                "ads.banner-click.example.net",
                "track.adserver.example.com",
                "www.spam-farm.example.org",
                "spam-links.example.com",
                "blog.casino-win.example.net",
                "casino-bonus.example.com",
                "free-bets.example.net",
                "sports-bets.example.org",
                "adult-x.example.com",
                "adult-videos.example.net",
                "blog.cheap-pills.example.net",
                "pills-online.example.com",
                "poker-slots.example.org",
                "porn-tube.example.com",
                "xxx-cams.example.net",
            ),
        ),
        (
            False,
            (
                "tionsh.example.net",
                "blog.tionble.example.com",
                "m.ththen.example.org",
                "www.theron.example.com",
                "therha.example.net",
                "news.site.example.com",
                "www.university.example.org",
                "library.example.net",
                "docs.project.example.org",
                "blog.travel.example.com",
                "www.science.example.net",
                "en.wiki.example.org",
                "forum.garden.example.com",
                "www.history.example.org",
                "m.weather.example.net",
                "recipes.kitchen.example.com",
            ),
        ),
    )
    for host in hosts
    for scheme, path in (("http://", "/en/120.html"), ("https://www.", "/fr/7"), ("https://", "/"))
)
MAX_LABELLED = 100_000
GRAMS = (3, 4, 5)
BITS = 16
STEPS = 300
RATE = 2.0
PENALTY = 1e-4


def url_parts(url: str | None) -> tuple[str, str]:
    """Host and path of one URL, as the columns below give them."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    stop = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return lower, rest[end:stop]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def features(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of host and path, each marked with where it comes from."""
    grams = {
        mark + text[i : i + n]
        for mark, text in (("h", f"^{host}$" if host else ""), ("p", path))
        for n in GRAMS
        for i in range(len(text) - n + 1)
    }
    return np.array(
        sorted({zlib.crc32(g.encode("utf-8", "replace")) % (1 << BITS) for g in grams}),
        dtype=np.int64,
    )


def trained(labelled: Sequence[tuple[str, bool]] = LABELLED) -> tuple[np.ndarray, float]:
    """Weights and bias: full-batch gradient steps, the same each time."""
    if not 0 < len(labelled) <= MAX_LABELLED:
        raise ValueError(f"between 1 and {MAX_LABELLED} labelled URLs are needed")
    rows = [features(*url_parts(url)) for url, _ in labelled]
    sizes = np.array([len(r) for r in rows])
    place, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    truth = np.array([float(blocked) for _, blocked in labelled])
    weights, bias = np.zeros(1 << BITS), 0.0
    for _ in range(STEPS):
        scores = np.bincount(owner, weights[place], len(rows)) * scale + bias
        error = (1 / (1 + np.exp(-scores)) - truth) / len(rows)
        slope = np.bincount(place, (error * scale)[owner], 1 << BITS)
        weights -= RATE * (slope * 8 + PENALTY * weights)
        bias -= RATE * error.sum()
    return weights, float(bias)


def block_probability(host: str, path: str, weights: np.ndarray, bias: float) -> float:
    found = features(host, path)
    if not len(found):
        return 0.0
    score = weights[found].sum() / np.sqrt(len(found)) + bias
    return float(1 / (1 + np.exp(-score)))


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple:
    """The rule that fits and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest last: it is the one that stays.
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def judged_urls(
    pages: DataFrame,
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: Sequence[tuple[str, bool]] = LABELLED,
) -> DataFrame:
    """(row, host, path, rule, verdict, probability) per row of ``pages``."""
    weights, bias = trained(labelled)

    @F.pandas_udf("double")
    def probability(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series(
                [
                    block_probability(h, p, weights, bias)
                    for h, p in zip(hosts, paths, strict=True)
                ],
                dtype=float,
            )

    url = F.col(url_col)
    parts = pages.select(
        F.struct(*pages.columns).alias("row"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    ).withColumn("probability", probability("host", "path"))
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("probability") > 0.5, "block").otherwise("allow")
    return parts.select(
        "row",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        "probability",
    )
