"""URL filter: rules by host and path prefix, gradient-boosted trees on lexical features for the rest.

Rules decide where one fits, the longest first.  URLs that no rule fits are judged by trees boosted
on the logistic loss over lexical features; they are trained from labelled URLs, which by default are
those that rules decide.  Host and path are cut with SQL functions; features and trees run over Arrow
batches in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import bounded_batches, hash_share, row_hash, session_of

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs the trees are fitted on, at most about so many of each verdict, chosen by hash.
TRAIN_URLS = 20_000
ROUNDS, DEPTH, RATE, BINS, LEAST, RIDGE = 40, 3, 0.2, 32, 20, 1.0
#: Suffixes with statistics of their own: those of at least so many training URLs.
LEAST_SUFFIX = 20
FEATURES = ("length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "parameters", "query_length", "hyphens", "fragment", "top_suffix", "suffix", "first_digits")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` ("host/path" to verdict) that fits: its host or a subdomain, its path a prefix."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[rule]


@dataclass
class UrlModel:
    """Boosted trees: arrays (rounds, nodes) of complete trees, and the suffix statistics."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    suffixes: dict[str, float]

    def probability(self, urls: list[str | None], hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of ``block``."""
        x = features(urls, hosts, paths, self.suffixes)
        total = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            total += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def suffixes_of(host: str) -> tuple[str, str]:
    """The last label, and the last two."""
    labels = host.rsplit(".", 2)
    return labels[-1], ".".join(labels[-2:])


def features(urls: list[str | None], hosts: list[str], paths: list[str], suffixes: dict[str, float]) -> np.ndarray:
    """A row of FEATURES for each URL; unknown suffixes have the neutral statistic 0."""
    out = np.zeros((len(urls), len(FEATURES)))
    for k, (url, host, path) in enumerate(zip(urls, hosts, paths, strict=True)):
        data = (url or "").encode()
        n = max(len(data), 1)
        counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        share = counts[counts > 0] / n
        query = (url or "").partition("#")[0].partition("?")[2]
        top, pair = suffixes_of(host)
        depth = sum(1 for x in path.split("/") if x)
        out[k] = (
            len(data), len(host), len(path), host.count(".") + bool(host), depth, counts[48:58].sum() / n,
            -(share * np.log2(share)).sum(), query.count("&") + bool(query), len(query), counts[45], "#" in (url or ""),
            suffixes.get(top, 0.0), suffixes.get(pair, 0.0), sum(c.isdigit() for c in path[:8]),
        )
    return out


def suffix_statistics(hosts: list[str], blocked: np.ndarray) -> dict[str, float]:
    """Smoothed log odds of ``block`` for each suffix, less those of all."""
    held: dict[str, np.ndarray] = {}
    for host, b in zip(hosts, blocked.tolist(), strict=True):
        for s in set(suffixes_of(host)):
            held.setdefault(s, np.zeros(2))[int(b)] += 1
    rate = np.log((blocked.sum() + 1) / (len(blocked) - blocked.sum() + 1))
    return {s: float(np.log((n[1] + 1) / (n[0] + 1)) - rate) for s, n in held.items() if n.sum() >= LEAST_SUFFIX}


def fit_trees(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(base, feature, cut, value) by histogram boosting with second-order leaf values."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    inner = 2**DEPTH - 1
    total = np.full(len(y), base)
    feature = np.zeros((ROUNDS, inner), np.int64)
    cut = np.full((ROUNDS, inner), np.inf)
    value = np.zeros((ROUNDS, inner + 1))
    for r in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = 1e-9
            if len(rows) >= 2 * LEAST:
                gs, hs = g[rows].sum(), h[rows].sum()
                for f in range(x.shape[1]):
                    gb, hb, nb = (np.cumsum(np.bincount(binned[rows, f], w, BINS)) for w in (g[rows], h[rows], np.ones(len(rows))))
                    gain = gb**2 / (hb + RIDGE) + (gs - gb) ** 2 / (hs - hb + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(nb < LEAST) | (len(rows) - nb < LEAST)] = 0
                    at = int(np.argmax(gain[: len(edges[f])])) if len(edges[f]) else 0
                    if len(edges[f]) and gain[at] > best:
                        best, feature[r, k], cut[r, k] = gain[at], f, edges[f][at]
            node[rows] = 2 * k + 1 + (x[rows, feature[r, k]] > cut[r, k])
        leaf = node - inner
        gl, hl = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        value[r] = -RATE * gl / (hl + RIDGE)
        total += value[r][leaf]
    return base, feature, cut, value


def train(labelled: DataFrame, url_col: str = "url", verdict_col: str = "verdict") -> UrlModel:
    """Trees from labelled URLs (verdicts ``allow`` and ``block``), about TRAIN_URLS of each, chosen by hash.

    Equal whole rows count once in the sample.  Rows without a verdict are left out.  No labelled rows: everything is allowed; one verdict only:
    that verdict.
    """
    rows = labelled.select(F.col(url_col).cast("string").alias("url"), F.col(verdict_col).alias("verdict"), row_hash(labelled).alias("_s")).where(F.col("verdict").isin(ALLOW, BLOCK)).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    held = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for verdict, n in held.items():
        chosen = chosen | ((F.col("verdict") == verdict) & hash_share(n, TRAIN_URLS, F.col("_s")))
    t = rows.where(chosen).dropDuplicates(["_s"]).select("url", "host", "path", "verdict").toArrow().sort_by([("url", "ascending"), ("verdict", "ascending")])
    none = np.zeros((0, 2**DEPTH - 1))
    if not t.num_rows:
        return UrlModel(-10.0, none.astype(np.int64), none, np.zeros((0, 2**DEPTH)), {})
    y = np.array([v == BLOCK for v in t["verdict"].to_pylist()], float)
    urls, hosts, paths = (t[c].to_pylist() for c in ("url", "host", "path"))
    if y.min() == y.max():
        return UrlModel(10.0 if y[0] else -10.0, none.astype(np.int64), none, np.zeros((0, 2**DEPTH)), {})
    known = suffix_statistics(hosts, y)
    return UrlModel(*fit_trees(features(urls, hosts, paths, known), y), known)


def judge(df: DataFrame, rules: dict[str, str], model: UrlModel, url_col: str = "url") -> DataFrame:
    """``df`` with host, path, rule, block_probability and verdict; columns of these names are replaced.

    A null url, or one without ``://``, has an empty host and path; no rule with a host fits it and the
    trees judge it by what it is.  No shuffle.
    """
    spark = session_of(df)
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def block_probability(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for urls, hosts, paths in batches:
            yield pa.array(shared.value.probability(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist()), pa.float64())

    url = F.col(url_col).cast("string")
    out = df.withColumns({"host": host_of(url), "path": path_of(url)})
    out = out.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn("block_probability", block_probability(url, "host", "path"))
    return out.withColumn("verdict", F.coalesce(verdict_of(F.col("rule"), rules), F.when(F.col("block_probability") >= 0.5, BLOCK).otherwise(ALLOW)))


def judge_with_rule_labels(df: DataFrame, rules: dict[str, str], url_col: str = "url") -> DataFrame:
    """``judge`` with trees trained on the URLs of ``df`` that rules decide."""
    rows = df.select(F.col(url_col).cast("string").alias("url"), row_hash(df).alias("seal")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    decided = rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).where("rule is not null")
    return judge(df, rules, train(decided.select("url", "seal", verdict_of(F.col("rule"), rules).alias("verdict"))), url_col)
