"""URL filter (operator 5): rules first, else a logistic regression on hashed
character n-grams of host and path.

* *Rules* allow or block a host and its subdomains below a path; the longest
  rule that fits decides. They are one native expression.
* *Model*: trained on a small labelled table of URLs (``MAX_LABELLED`` rows at
  most, in hash order), on the driver, by full-batch descent, so that equal
  tables give equal weights. Host and path have n-grams of their own.
  Scoring runs where the URLs are.

``url_report`` takes the labelled table from the URLs that a rule decides.

Edge cases: a null URL, or one without ``://``, has empty host and path, no rule
and the model's verdict for them; without labelled URLs of both verdicts the
model gives the only one there is, allow if there is none; ties and repeated
rows are judged alike; the html and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.words import mixed

MAX_LABELLED = 4000
BITS = 16
GRAMS = (3, 4, 5)
ROUNDS = 200
RIDGE = 1e-5

#: The rules.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, below = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + below)
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if out is None else out


def verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for text, verdict in rules:
        out = F.when(rule == text, F.lit(verdict)).otherwise(out)
    return out


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hashed n-gram, weight) of all n-grams; a row's weights have length 1
    when its n-grams are different."""
    rows, grams = [], []
    for salt, texts in ((1, hosts), (2, paths)):
        raw = [b"\x02" + t.encode() + b"\x03" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        size = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(size)
        owner = np.repeat(np.arange(len(raw)), size)
        left = np.repeat(ends, size) - np.arange(len(data))
        for n in GRAMS:
            whole = np.flatnonzero(left >= n)
            if not len(whole):
                continue
            h = np.full(len(whole), (salt << 8) + n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) ^ data[whole + k]
            grams.append((mixed(h) >> np.uint64(64 - BITS)).astype(np.int64))
            rows.append(owner[whole])
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    gram = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    count = np.bincount(row, minlength=len(hosts))
    return row, gram, 1 / np.sqrt(np.maximum(count, 1))[row]


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of block."""
        row, gram, weight = features(hosts, paths)
        z = np.bincount(row, self.weights[gram] * weight, minlength=len(hosts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(labelled: DataFrame, most: int = MAX_LABELLED) -> Model:
    """``labelled``: host, path, verdict; at most ``most`` different rows count."""
    rows = (labelled.select("host", "path", "verdict").distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(most).collect())
    y = np.array([float(r["verdict"] == "block") for r in rows])
    weights = np.zeros(1 << BITS)
    if len(set(y.tolist())) < 2:
        return Model(weights, 20.0 if len(y) and y[0] else -20.0)
    row, gram, weight = features([r["host"] for r in rows], [r["path"] for r in rows])
    used, at = np.unique(gram, return_inverse=True)
    w = v = np.zeros(len(used) + 1)
    step = 2.0      # rows have length 1, so the curvature is 1/2 at most, intercept included
    for k in range(ROUNDS):
        z = np.bincount(row, v[at] * weight, minlength=len(y)) + v[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        slope = np.r_[np.bincount(at, miss[row] * weight, minlength=len(used)) + RIDGE * v[:-1], miss.sum()]
        new = v - step * slope
        w, v = new, new + k / (k + 3) * (new - w)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]))


def judged(pages: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule) of every row."""
    host, path = host_and_path(F.col(url_column).cast("string"))
    parts = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    return parts.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))


def url_report(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, id_column: str = "page_id",
               url_column: str = "url", most: int = MAX_LABELLED) -> DataFrame:
    """One row for each row: id, host, path, rule, verdict, block_score.
    ``labelled``: a table of host, path and verdict; by default the URLs that a
    rule decides."""
    rows = judged(pages, rules, id_column, url_column)
    if labelled is None:
        labelled = rows.where(F.col("rule").isNotNull()).withColumn("verdict", verdict_of(F.col("rule"), rules))
    model = fit(labelled, most)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "block_score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"id {kind}, host string, path string, rule string, block_score double")
    guess = F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("id").alias(id_column), "host", "path", "rule",
                         F.coalesce(verdict_of(F.col("rule"), rules), guess).alias("verdict"), "block_score")
