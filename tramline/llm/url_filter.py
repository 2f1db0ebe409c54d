"""URL filter: longest-match rules, and logistic regression on hashed character n-grams of host and path for all other URLs.

Defined results: a null URL, or one without ``://``, has an empty host and path and is judged on those; hosts are
lower-cased in A-Z only; URLs of any length are read whole; of rules of one length that both fit (which needs equal text) the later one in the given order holds;
equal scores get equal verdicts, and a score at the threshold blocks; repeated rows get equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import ascii_lower, ship

DIMENSIONS = 1 << 15
LENGTHS = (3, 4, 5)
#: At most so many labelled URLs are used for fitting, those with the smallest hash.
MAX_LABELLED = 20_000

DIGITS = str.maketrans("123456789", "000000000")

#: The small labelled table that is used where no better one is given: label (1 for unwanted) and URL, each host with words of its own.
TABLE = Path(__file__).with_name("labelled_urls.txt")


def labelled_urls(path: Path | str = TABLE) -> list[tuple[str, int]]:
    """(url, unwanted 0/1) of a table file."""
    lines = (line.split("\t") for line in Path(path).read_text().splitlines())
    return [(url, int(label)) for label, url in lines]


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    rest = F.when(url.contains("://"), F.expr("1")).isNotNull()
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(rest, ascii_lower(after)).otherwise(empty), F.when(rest, path).otherwise(empty)


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. A rule is ``host/path-prefix``; it fits subdomains too."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams, digits alike; host and path have a name space each."""
    found = set()
    for kind, text in (("h", f"^{host}$".translate(DIGITS)), ("p", f"^{path}$".translate(DIGITS))):
        found.update(zlib.crc32(f"{kind}{text[i : i + n]}".encode("utf-8", "replace")) % DIMENSIONS for n in LENGTHS for i in range(len(text) - n + 1))
    return np.fromiter(found, np.int64, len(found))


def split_url(url: str | None) -> tuple[str, str]:
    """As parts_of(), for the labelled table."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def fit(labelled: Iterable[tuple[str, int]], rounds: int = 400, rate: float = 10.0, penalty: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression, by full-batch gradient descent (deterministic)."""
    by_hash = sorted({(u or "", int(y)) for u, y in labelled}, key=lambda r: (zlib.crc32(r[0].encode("utf-8", "replace")), r))
    rows = sorted(by_hash[:MAX_LABELLED])  # a sample, not the first in URL order
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not rows:
        return weights, -1.0
    sets = [grams(*split_url(u)) for u, _ in rows]
    y = np.array([label for _, label in rows], float)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    scale = 1.0 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(sets))))
    for _ in range(rounds):
        z = np.bincount(owner, weights[flat], len(sets)) * scale + bias
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        weights -= rate * (np.bincount(flat, (error * scale)[owner], DIMENSIONS) + penalty * weights)
        bias -= rate * error.sum()
    return weights, float(bias)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], labelled: DataFrame | Iterable[tuple[str, int]] | None = None, threshold: float = 0.7, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): score is the model's probability that the URL is unwanted; it blocks from ``threshold`` on, which favours precision.

    ``labelled`` is a small table (url, label), at most MAX_LABELLED rows of which are fitted on the driver.
    """
    ship(pages.sparkSession)
    if isinstance(labelled, DataFrame):
        labelled = [tuple(r) for r in labelled.orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED).collect()]
    weights, bias = fit(labelled_urls() if labelled is None else labelled)
    model = pages.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # DIMENSIONS numbers, whatever the data

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = model.value
        for hosts, paths in batches:
            yield pd.Series([float(w[g].sum() / max(1, len(g)) ** 0.5) for g in map(grams, hosts, paths)], dtype="float64")

    host, path = parts_of(F.col(url))
    out = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    out = out.withColumn("score", 1 / (1 + F.exp(-(score("host", "path") + F.lit(bias)))))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = out.withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow"))})
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
