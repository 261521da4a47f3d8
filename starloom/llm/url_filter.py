"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The rules label the URLs they fit; the trees learn from those and judge the
others. Features are lexical alone: lengths, path depth, digit ratio, byte
entropy, counts of parameters and signs, and statistics of the host's suffixes,
the path's first segment and its file suffix: the smoothed share of blocked URLs among
all labelled ones with the same suffix. Suffixes are hashed into a fixed number
of slots, so the statistics (over all labelled URLs) have a fixed size whatever
the number of hosts. The trees are fitted on a bounded sample, ``SAMPLE_ROWS``
labelled URLs with the smallest id hash; scoring is one pass without a shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and path
and fits no rule; its features are zeros, and the trees judge it. Without labelled URLs of
both verdicts the score is the smoothed share of blocked ones. Repeated rows
each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict and rule (host, then path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
SLOTS = 4096
SMOOTHING = 5.0
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _suffix_slots(host: Column, path: Column) -> list[Column]:
    """Slots of the host's last label, last two labels and whole, of the path's first segment and file suffix."""
    parts = {"tld": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2), "host": host,
             "segment": F.regexp_extract(path, r"^/([^/]*)/", 1), "file": F.regexp_extract(path, r"(\.[A-Za-z0-9]{1,8})$", 1)}
    return [F.pmod(F.xxhash64(F.lit(k), v), F.lit(SLOTS)).cast("int").alias(f"s{i}") for i, (k, v) in enumerate(parts.items())]


N_STATISTICS = 5


def _byte_matrix(column: pa.Array) -> np.ndarray:
    """How often each byte occurs in each text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros((len(column), 256))
    part = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]].astype(np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    return np.bincount(row * 256 + part, minlength=len(column) * 256).reshape(-1, 256).astype(np.float64)


def features(batch: pa.RecordBatch, shares: np.ndarray) -> np.ndarray:
    """A row of lexical features for each URL of a batch with ``url``, ``host``, ``path`` and slots."""
    url, host, path = (_byte_matrix(batch.column(c)) for c in ("url", "host", "path"))
    n = np.maximum(url.sum(1), 1)
    p = url / n[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    digits = url[:, 48:58].sum(1)
    count = lambda m, signs: m[:, list(signs.encode())].sum(1)
    cols = [url.sum(1), host.sum(1), path.sum(1), count(path, "/"), digits / n, path[:, 48:58].sum(1), entropy,
            count(url, "?&"), count(url, "="), count(url, "#"), count(host, "."), count(url, "-_"), count(url, "%"),
            host[:, 48:58].sum(1)]
    for k in range(N_STATISTICS):
        cols.append(shares[k, batch.column(f"s{k}").to_numpy(zero_copy_only=False)])
    return np.stack(cols, 1)


@dataclass
class Trees:
    """Boosted trees of one depth: per tree the feature and cut of each inner node and the value of each leaf."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (len(feature))]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 48,
              least: float = 1.0, ridge: float = 1.0) -> Trees:
    """Newton boosting on histograms of the features' quantiles, for logistic loss."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not 0 < y.sum() < len(y):
        return Trees(base, depth, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
    k = x.shape[1]
    z, made = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            own = node - first
            at = (own[:, None] * k + np.arange(k)) * bins + binned
            hg = np.bincount(at.ravel(), np.repeat(g, k), minlength=width * k * bins).reshape(width, k, bins)
            hh = np.bincount(at.ravel(), np.repeat(h, k), minlength=width * k * bins).reshape(width, k, bins)
            lg, lh = hg.cumsum(2), hh.cumsum(2)
            tg, th = lg[:, :, -1:], lh[:, :, -1:]
            gain = lg ** 2 / (lh + ridge) + (tg - lg) ** 2 / (th - lh + ridge) - tg ** 2 / (th + ridge)
            gain[(lh < least) | (th - lh < least)] = -np.inf
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            for w in range(width):
                f, b = divmod(int(best[w]), bins)
                if flat[w, best[w]] > 1e-9 and b < len(cuts[f]):
                    feature[first + w], cut[first + w] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        own = node - inner
        value = -rate * np.bincount(own, g, minlength=leaves) / (np.bincount(own, h, minlength=leaves) + ridge)
        z += value[own]
        made.append((feature, cut, value))
    return Trees(base, depth, *(np.stack(c) for c in zip(*made)))


def judge_urls(pages: DataFrame, *, rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD,
               sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the trees' ``score`` of every URL."""
    sc = pages.sparkSession.sparkContext
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, kind = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "kind": kind})
    slots = _suffix_slots(F.col("host"), F.col("path"))
    names = [f"s{k}" for k in range(N_STATISTICS)]

    labelled = rows.where(F.col("kind").isNotNull()).withColumn("label", (F.col("kind") == "block").cast("int"))
    slot = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), s.alias("slot")) for k, s in enumerate(slots)])).alias("e")
    counted = (labelled.select("label", slot).groupBy("e.k", "e.slot")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).collect())  # at most 5 * SLOTS rows
    n, blocked = np.zeros((N_STATISTICS, SLOTS)), np.zeros((N_STATISTICS, SLOTS))
    for r in counted:
        n[r["k"], r["slot"]], blocked[r["k"], r["slot"]] = r["n"], r["blocked"]
    prior = (blocked[0].sum() + 0.5) / (n[0].sum() + 1)
    shares = (blocked + SMOOTHING * prior) / (n + SMOOTHING)

    sample = (labelled.select("page_id", "url", "host", "path", "label", *slots)
              .orderBy(F.xxhash64("page_id", "url"), "page_id", "url").limit(sample_rows).toArrow().combine_chunks())
    batches = sample.to_batches()
    if batches:
        x = np.concatenate([features(b, shares) for b in batches])
        trees = fit_trees(x, sample["label"].to_numpy().astype(np.float64))
    else:
        trees = fit_trees(np.zeros((0, 1)), np.zeros(0))
    shared = sc.broadcast((trees, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, shares = shared.value
        for batch in batches:
            z = trees.margins(features(batch, shares))
            cols = [batch.column(c) for c in ("page_id", "host", "path", "rule", "kind")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))],
                                             ["page_id", "host", "path", "rule", "kind", "score"])

    scored = rows.select("page_id", "url", "host", "path", "rule", "kind", *slots).mapInArrow(
        run, "page_id long, host string, path string, rule string, kind string, score double")
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("kind", own).alias("verdict"), "score")
