"""URL filter: rules first, then logistic regression on hashed character
n-grams of host and path.

A rule ``host/path`` fits the host and its subdomains if the path of the url
starts with the rule's path; the longest fitting rule decides. For the others
a linear model decides, trained from a small labelled url table.

Edge cases: a null url, or one without ``://``, has an empty host and path and
is judged by the model's intercept alone. Without labelled urls, or with one
label only, every url not under a rule gets that label (``allow`` if there is
none). Columns other than id and url are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import values

ALLOW, BLOCK = "allow", "block"
DIMENSIONS = 1 << 14
GRAMS = (3, 4, 5)
TRAIN_ROWS = 20_000     # labelled urls the fit uses at most, those of lowest hash
STEPS = 60
RIDGE = 1e-3
BATCH_URLS = 4096

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z
    lower-cased; path from there up to ``? #``. Empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def split_urls(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """``id, host, path`` of every row."""
    slim = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = parts(F.col("url"))
    return slim.select("id", host.alias("host"), path.alias("path"))


class Rules:
    """Rules by host; ``match`` looks up the host and each parent domain."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append(("/" + path, rule, verdict))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fitting rule."""
        best = None
        labels = host.split(".")
        for i in range(len(labels)):
            for start, rule, verdict in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
        return best


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram places of all urls and the row each belongs to. Host and
    path hash apart; the ends of each are marked."""
    where, rows = [], []
    for salt, texts in ((1, hosts), (2, paths)):
        raw = [b"^" + t.encode() + b"$" if t else b"" for t in texts]
        sizes = np.array([len(t) for t in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(raw)), sizes)
        for n in GRAMS:
            if len(flat) < n:
                continue
            h = np.full(len(flat) - n + 1, salt * 131 + n, dtype=np.uint64)
            for k in range(n):
                h = (h ^ flat[k:len(flat) - n + 1 + k]) * np.uint64(0x100000001B3)
                h ^= h >> np.uint64(29)
            inside = row[:len(h)] == row[n - 1:]
            where.append((h[inside] % np.uint64(DIMENSIONS)).astype(np.int64))
            rows.append(row[:len(h)][inside])
    if not where:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(where), np.concatenate(rows)


def _logits(weights: np.ndarray, bias: float, hosts: list[str], paths: list[str]) -> np.ndarray:
    at, row = features(hosts, paths)
    total = np.bincount(row, weights[at], minlength=len(hosts))
    count = np.bincount(row, minlength=len(hosts))
    return bias + total / np.sqrt(np.maximum(count, 1))


def train(rows: list[tuple[str, str, int]]) -> tuple[np.ndarray, float]:
    """(weights, bias) of P(block) from ``(host, path, blocked)`` rows by
    gradient descent with momentum on the ridge-regularised log loss."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    y = np.array([r[2] for r in rows], dtype=np.float64)
    if len(rows) == 0 or y.min() == y.max():
        return weights, -20.0 if len(rows) == 0 or y[0] == 0 else 20.0
    at, row = features([r[0] for r in rows], [r[1] for r in rows])
    norm = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    speed, speed_bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(STEPS):
        logit = bias + np.bincount(row, weights[at], minlength=len(y)) * norm
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
        grad = np.bincount(at, (error * norm)[row], minlength=DIMENSIONS) / len(y) + RIDGE * weights
        speed = 0.9 * speed - 1.0 * grad
        speed_bias = 0.9 * speed_bias - 1.0 * error.mean()
        weights, bias = weights + speed, bias + speed_bias
    return weights, float(bias)


def labelled_by_rules(split: DataFrame, rules: list[tuple[str, str]], limit: int = TRAIN_ROWS) -> DataFrame:
    """A small labelled url table: distinct ``host, path`` that rules decide,
    ``limit`` of them at most, by lowest hash."""
    ship.ensure(split.sparkSession)
    lookup = Rules(rules)

    def run(batches):
        for batch in batches:
            hosts, paths = values(batch, "host"), values(batch, "path")
            found = [lookup.match(h, p) for h, p in zip(hosts, paths)]
            keep = [i for i, f in enumerate(found) if f]
            yield pa.record_batch([pa.array([hosts[i] for i in keep], pa.string()),
                                   pa.array([paths[i] for i in keep], pa.string()),
                                   pa.array([int(found[i][1] == BLOCK) for i in keep], pa.int32())],
                                  names=["host", "path", "blocked"])

    known = split.select("host", "path").distinct().mapInArrow(run, "host string, path string, blocked int")
    return known.orderBy(F.xxhash64("host", "path"), "host", "path").limit(limit)


def judge(split: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame,
          limit: int = TRAIN_ROWS) -> DataFrame:
    """``id, host, path, rule, verdict, p_block`` for ``split(id, host,
    path)``. ``labelled(host, path, blocked)``; at most ``limit`` rows train."""
    ship.ensure(split.sparkSession)
    rows = [(r["host"] or "", r["path"] or "", r["blocked"]) for r in labelled.where(
        "blocked is not null").limit(limit).collect()]
    weights, bias = train(sorted(rows))
    lookup = Rules(rules)
    kind = dict(split.dtypes)["id"]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_URLS):
                part = batch.slice(start, BATCH_URLS)
                hosts, paths = values(part, "host"), values(part, "path")
                p = 1 / (1 + np.exp(-np.clip(_logits(weights, bias, hosts, paths), -500, 500)))
                found = [lookup.match(h, q) for h, q in zip(hosts, paths)]
                verdict = [f[1] if f else (BLOCK if x >= 0.5 else ALLOW) for f, x in zip(found, p)]
                yield pa.record_batch([
                    part.column(part.schema.get_field_index("id")),
                    pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                    pa.array([f[0] if f else None for f in found], pa.string()),
                    pa.array(verdict, pa.string()), pa.array(p)],
                    names=["id", "host", "path", "rule", "verdict", "p_block"])

    return split.select("id", "host", "path").mapInArrow(
        run, f"id {kind}, host string, path string, rule string, verdict string, p_block double")
