"""Gradient-boosted trees over histograms, as flat arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablebridge.llm.staging import stage

TREES, DEPTH, BINS, RATE, SMOOTH, LEAST = 60, 4, 64, 0.2, 1.0, 10.0
#: Gradients of a table are summed as whole numbers of this fraction, so their sums do not depend on an order.
UNIT = 2.0**-20


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node k of a tree goes to 2k+1 if its feature is at most its threshold, else to 2k+2."""

    feature: np.ndarray  # trees x (2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2**depth
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row; all trees take a level together."""
        depth, rows, trees = self.leaf.shape[1].bit_length() - 1, np.arange(len(x))[:, None], np.arange(len(self.leaf))[None]
        out = np.empty(len(x))
        for i in range(0, len(x), 4096):
            part = x[i : i + 4096]
            at = np.zeros((len(part), len(self.leaf)), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (part[rows[: len(part)], self.feature[trees, at]] > self.threshold[trees, at])
            out[i : i + 4096] = self.base + self.leaf[trees, at - (self.leaf.shape[1] - 1)].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def gains(g: np.ndarray, h: np.ndarray, c: np.ndarray, cuts: int) -> np.ndarray:
    """What a split after each bin gains, by node: gradients, second derivatives and counts are [node, bin]."""
    gl, hl, cl = (a.cumsum(axis=1)[:, :-1] for a in (g, h, c))
    gt, ht, ct = (a.sum(axis=1, keepdims=True) for a in (g, h, c))
    gain = gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH) - gt**2 / (ht + SMOOTH)
    gain[(cl < LEAST) | (ct - cl < LEAST)] = 0
    gain[:, cuts:] = 0
    return gain


def start(positive: float, rows: float) -> float:
    """The log-odds before the first tree."""
    share = np.clip((positive + 0.5) / (rows + 1), 1e-6, 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic loss, second-order gains, quantile bins; the same rows always give the same trees.

    No rows: every score is 0.5. One class only: every score is near to that class.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) if len(x) else np.zeros(0) for j in range(width)]
    bins = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], axis=1) if width and len(x) else np.zeros((len(x), width), int)
    base = start(y.sum(), len(y))
    feature = np.zeros((trees, 2**depth - 1), np.int64)
    threshold = np.full((trees, 2**depth - 1), np.inf)
    leaf = np.zeros((trees, 2**depth))
    margin = np.full(len(y), base)
    one_class = len(y) == 0 or y.min() == y.max()
    for t in range(trees if not one_class else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.zeros(n)
            where = node - first
            for j in range(width):
                if not len(cuts[j]):
                    continue
                key = where * BINS + bins[:, j]
                hist = [np.bincount(key, w, n * BINS).reshape(n, BINS) for w in (g, h, None)]
                gain = gains(*hist, len(cuts[j]))
                at = gain.argmax(axis=1)
                value = gain[np.arange(n), at]
                for k in np.flatnonzero(value > best + 1e-9):
                    best[k], feature[t, first + k], threshold[t, first + k] = value[k], j, cuts[j][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        end = node - (2**depth - 1)
        leaf[t] = -RATE * np.bincount(end, g, 2**depth) / (np.bincount(end, h, 2**depth) + SMOOTH)
        margin += leaf[t][end]
    return Trees(feature, threshold, leaf, base)


def walk(x: Column, feature: np.ndarray, threshold: np.ndarray, leaf: Callable[[int], Column], k: int = 0) -> Column:
    """leaf(number of the end) that an array `x` reaches from node k of one tree."""
    inner = len(feature)
    if k >= inner:
        return leaf(k - inner)
    left = walk(x, feature, threshold, leaf, 2 * k + 1)
    if not np.isfinite(threshold[k]):
        return left
    return F.when(F.get(x, F.lit(int(feature[k]))) <= F.lit(float(threshold[k])), left).otherwise(walk(x, feature, threshold, leaf, 2 * k + 2))


def quantiles(cases: DataFrame, rows: int) -> dict[int, list[float]]:
    """The distinct values at BINS - 1 even positions of each feature, over all cases.

    Values are counted before they are ordered, so a feature's window has as many rows as it has values.
    """
    values = cases.select("n", F.posexplode("x").alias("j", "value")).groupBy("j", "value").agg(F.sum("n").alias("n"))
    ranked = values.withColumn("upto", F.sum("n").over(W.partitionBy("j").orderBy("value").rowsBetween(W.unboundedPreceding, 0)))
    here = F.expr(f"exists(sequence(1L, {BINS - 1}L), k -> k * {rows - 1}L div {BINS} between upto - n and upto - 1)")
    found: dict[int, list[float]] = {}
    for r in ranked.where(here).select("j", "value").collect():
        found.setdefault(r.j, []).append(r.value)
    return {j: sorted(found[j]) for j in sorted(found)}


def train_table(cases: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """`train` over every row of a table (x array<double>, n, positive): n cases have these features, `positive` of them class 1.

    Spark sums a histogram a level; the driver sees nodes times features times BINS sums. The same
    cases always give the same trees, in whatever order and parts they come.
    """
    total = cases.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("positive"), F.lit(0)).alias("positive")).first()
    base = start(total.positive, total.n)
    inner = 2**depth - 1
    feature, leaf = np.zeros((trees, inner), np.int64), np.zeros((trees, inner + 1))
    threshold, place = np.full((trees, inner), np.inf), np.full((trees, inner), np.inf)
    if total.positive in (0, total.n):
        return Trees(feature, threshold, leaf, base)
    cuts = quantiles(cases, total.n)
    below = lambda j: F.size(F.filter(F.array(*map(F.lit, cuts[j])), lambda c: c < F.get("x", F.lit(j))))
    counted = cases.select(F.array(*map(below, cuts)).alias("bins"), "n", "positive").groupBy("bins")
    binned = stage(counted.agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")), "bins")
    margin = F.lit(base)
    whole = lambda c: F.round(c / UNIT).cast("long")
    for t in range(trees):
        p = binned.select("bins", "n", "positive", (1 / (1 + F.exp(-margin))).alias("p"))
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            node = walk(F.col("bins"), feature[t, :first], place[t, :first], F.lit)
            sides = p.select(node.alias("node"), "n", whole(F.expr("n * p - positive")).alias("g"), whole(F.expr("n * p * (1 - p)")).alias("h"), F.posexplode("bins").alias("j", "bin"))
            hist = np.zeros((3, len(cuts), n, BINS))
            for r in sides.groupBy("node", "j", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect():
                hist[:, r.j, r.node, r.bin] = r.g * UNIT, r.h * UNIT, r.n
            best, ends = np.zeros(n), np.stack([hist[:2, 0].sum(axis=2), np.zeros((2, n))], axis=2)
            for j, own in enumerate(cuts.values()):
                gain = gains(*hist[:, j], len(own))
                at = gain.argmax(axis=1)
                for k in range(n):
                    if gain[k, at[k]] > best[k] + 1e-9:
                        best[k], feature[t, first + k], place[t, first + k], threshold[t, first + k] = gain[k, at[k]], j, at[k], own[at[k]]
                        ends[:, k, 0], ends[:, k, 1] = hist[:2, j, k, : at[k] + 1].sum(axis=1), hist[:2, j, k, at[k] + 1 :].sum(axis=1)
            if level == depth - 1:
                g, h = ends.reshape(2, -1)
                leaf[t] = -RATE * g / (h + SMOOTH)
        margin = margin + walk(F.col("bins"), feature[t], place[t], lambda k, t=t: F.lit(float(leaf[t, k])))
    feature = np.array(list(cuts))[feature]
    return Trees(feature, threshold, leaf, base)
