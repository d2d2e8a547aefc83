"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from tablebridge.llm.staging import stage

#: Steps of a component, ids that are anchors, ids whose label moves on by one of so many labels.
SCALE, ANCHORS, MOVED, LABELS = 256, 50, 7, 10
#: Positives of an anchor, negatives of a positive, and the window of negative scores in per cent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Rows whose lists are sorted together, and anchors whose finds are handed on together.
SHARD, BATCH = 4096, 1024
#: Shards and batches that meet in one task at most. It holds these anchors and one shard: its memory, at every size of the table.
HELD = 16
#: Depths of sorted access taken in the first step; each further step takes twice as many.
FIRST_STEP = 64


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")).cast("long"))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) -> (vec_id, label, q): one row an id, labels moved on, components as whole numbers.

    Null ids, labels, vectors and components and non-finite components take no part. Of rows with one id the
    least (label, q) stays.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    some = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    label = F.when(F.col("vec_id") % MOVED == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label").cast("long"))
    least = some.select("vec_id", F.struct(label.alias("label"), whole(F.col("embedding")).alias("q")).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return least.select("vec_id", "row.label", "row.q")


def parts(n_rows: int, n_anchors: int, least: int) -> tuple[int, int]:
    """Into how many parts rows and anchors are dealt, as each part of the rows meets each part of the anchors in a task of its own.

    A part has HELD shards or batches at most. Until there are `least` tasks the side is cut further that costs fewer copies, down to a shard or a batch.
    """
    n_shards, n_batches = -(-n_rows // SHARD) or 1, -(-n_anchors // BATCH) or 1
    of_rows, of_anchors = -(-n_shards // HELD), -(-n_batches // HELD)
    while of_rows * of_anchors < least:
        if of_rows < n_shards and (of_anchors == n_batches or n_anchors * of_rows <= n_rows * of_anchors):
            of_rows += 1
        elif of_anchors < n_batches:
            of_anchors += 1
        else:
            break
    return of_rows, of_anchors


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in whole numbers; in doubles where those are exact, which is many times quicker."""
    if len(b) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2**53:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    return a @ b


class Lists:
    """A shard's rows, and for each dimension its row numbers by ascending component."""

    def __init__(self, rows: pa.StructArray, width: int):
        self.ids, self.labels = np.asarray(rows.field("vec_id")), np.asarray(rows.field("label"))
        self.q = matrix(rows.field("q"), width)
        self.real, self.most = self.q.astype(float), float(np.abs(self.q).max(initial=0))
        self.order = np.argsort(self.q.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.q.T, self.order, axis=1)

    def exact(self, anchor: np.ndarray) -> bool:
        """Scores and thresholds are whole numbers that doubles hold."""
        return len(anchor) * self.most * float(np.abs(anchor).max(initial=0)) < 2**53

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return (self.real[rows] @ anchor.astype(float)).astype(np.int64) if self.exact(anchor) else self.q[rows] @ anchor

    def visit(self, anchor: np.ndarray, enough: Callable[[np.ndarray, np.ndarray, int], bool]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers seen and their scores when `enough(numbers, scores, threshold)` holds.

        A list is read from its high end where the anchor's component is positive, from its low end where it
        is negative and not at all where it is zero. A row new to any list is scored at once from all its
        components. No row beyond depth d can score more than the sum of the lists' contributions at depth d.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor)
        up = anchor[used] > 0
        high, low, part, exact = used[up], used[~up], anchor[used], self.exact(anchor)
        seen = np.zeros(n, bool)
        numbers, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_STEP
        while depth < n and len(used):
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[high, n - end : n - depth]] = True
            fresh[self.order[low, depth:end]] = True
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            numbers, scores = np.concatenate([numbers, new]), np.concatenate([scores, self.scores(new, anchor)])
            at = np.where(up, self.sorted[used, n - end], self.sorted[used, end - 1])
            depth, step = end, 2 * step
            if len(numbers) == n or enough(numbers, scores, int(part @ at) if exact else sum(int(x) * int(y) for x, y in zip(part, at, strict=True))):
                return numbers, scores
        return np.arange(n), product(self.q, anchor)


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Components of vectors, one row each; a shorter vector has zeros behind its own."""
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < np.asarray(vectors.value_lengths())[:, None]] = np.asarray(vectors.flatten())
    return out


def best(numbers: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first k by higher score, then smaller id, as indexes into numbers."""
    return np.lexsort((ids[numbers], -scores))[:k]


def kth(scores: np.ndarray, k: int) -> int | None:
    return None if len(scores) < k else int(np.partition(scores, len(scores) - k)[len(scores) - k])


def local_positives(lists: Lists, anchor: dict, vector: np.ndarray) -> Iterator[tuple]:
    """The shard's first POSITIVES other rows of the anchor's label: (anchor_id, anchor_id, 0, row id, score)."""

    def mine(numbers: np.ndarray) -> np.ndarray:
        return (lists.labels[numbers] == anchor["label"]) & (lists.ids[numbers] != anchor["vec_id"])

    def enough(numbers: np.ndarray, scores: np.ndarray, threshold: int) -> bool:
        least = kth(scores[mine(numbers)], POSITIVES)
        return least is not None and threshold < least

    numbers, scores = lists.visit(vector, enough)
    keep = mine(numbers)
    numbers, scores = numbers[keep], scores[keep]
    for i in best(numbers, scores, lists.ids, POSITIVES):
        yield anchor["vec_id"], anchor["vec_id"], 0, int(lists.ids[numbers[i]]), int(scores[i])


def local_negatives(lists: Lists, anchor: dict, vector: np.ndarray) -> Iterator[tuple]:
    """The shard's first NEGATIVES rows in the window of each of the anchor's positives: (anchor_id, positive_id, positive score, row id, score)."""
    # Whole bounds: 100 s >= LOW p and 100 s <= HIGH p.
    windows = [(p["id"], p["score"], -(-LOW * p["score"] // 100), HIGH * p["score"] // 100) for p in anchor["positives"]]

    def enough(numbers: np.ndarray, scores: np.ndarray, threshold: int) -> bool:
        other = scores[lists.labels[numbers] != anchor["label"]]
        for _, _, low, high in windows:
            if low > high or threshold < low:
                continue
            least = kth(other[(other >= low) & (other <= high)], NEGATIVES)
            if least is None or threshold >= least:
                return False
        return True

    numbers, scores = lists.visit(vector, enough)
    other = lists.labels[numbers] != anchor["label"]
    numbers, scores = numbers[other], scores[other]
    for positive, score, low, high in windows:
        inside = (scores >= low) & (scores <= high)
        some, of = numbers[inside], scores[inside]
        for i in best(some, of, lists.ids, NEGATIVES):
            yield anchor["vec_id"], positive, score, int(lists.ids[some[i]]), int(of[i])


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(shard, its rows) of rows that are sorted by shard."""
    last, some = None, []
    for b in batches:
        shard = np.asarray(b.column("shard"))
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if some and shard[start] != last:
                yield last, pa.concat_batches(some)
                some = []
            last = int(shard[start])
            some.append(b.slice(start, end - start))
    if some:
        yield last, pa.concat_batches(some)


def dealt(anchors: DataFrame, rows: DataFrame, of_rows: int, of_anchors: int, n_shards: int) -> DataFrame:
    """One partition for each pair of parts, with its anchors (shard -1) before its rows by shard.

    Copies go through one shuffle, none through the driver: a join would let Spark broadcast all copies of the anchors, which it takes for as small as their file.
    """
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(of_anchors))
    copies = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    asked = anchors.select(copies(of_rows).alias("of_rows"), part.alias("of_anchors"), F.lit(-1).cast("long").alias("shard"), *anchors.columns)
    met = rows.select(F.floor(shard * of_rows / n_shards).alias("of_rows"), copies(of_anchors).alias("of_anchors"), shard.alias("shard"), *rows.columns)
    both = asked.unionByName(met, allowMissingColumns=True).withColumn("cell", (F.col("of_rows") * of_anchors + F.col("of_anchors")).cast("int"))
    return both.repartitionById(of_rows * of_anchors, "cell").drop("cell", "of_rows", "of_anchors").sortWithinPartitions("shard")


def cells(anchors: DataFrame, rows: DataFrame, width: int, local: Callable[[Lists, dict, np.ndarray], Iterator[tuple]]) -> DataFrame:
    """Every anchor meets every shard once: (anchor_id, positive_id, positive_score, id, score), the shard's best rows of each window.

    The anchors are a stated share of the rows, so this is a search in blocks; a task holds one part of the anchors and one shard at a time.
    """
    names, batch = ["anchor_id", "positive_id", "positive_score", "id", "score"], BATCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, vectors = [], np.zeros((0, width), np.int64)
        for shard, some in stretches(batches):
            if shard < 0:
                asked, vectors = some.drop_columns(["shard", "q"]).to_pylist(), matrix(some.column("q"), width)
                continue
            lists = Lists(some.to_struct_array(), width) if asked else None
            for start in range(0, len(asked), batch):
                found = [x for i in range(start, min(start + batch, len(asked))) for x in local(lists, asked[i], vectors[i])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

    n_rows, least = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_rows, of_anchors = parts(n_rows, anchors.count(), least)
    return dealt(anchors, rows, of_rows, of_anchors, -(-n_rows // SHARD) or 1).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key over all shards, with their rank; ranks are limited before the shuffle."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Null or non-finite rows take no part, repeated ids count once (`usable`). Vectors of unlike lengths are
    compared as if zeros followed the shorter one. Higher scores come first, ties by smaller id. An anchor
    without positives, or a window without rows, gives no row, as does an empty table. Other columns are not
    read. Scores are 64-bit whole numbers.
    """
    some = stage(usable(rows), "vectors")
    width = some.agg(F.max(F.size("q"))).first()[0] or 0
    anchors = stage(some.where(F.col("vec_id") % ANCHORS == 0), "anchors")
    near = first(cells(anchors, some, width, local_positives), ["anchor_id"], POSITIVES)
    of = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    asking = stage(anchors.hint("merge").join(of, "vec_id"), "asking")
    found = first(cells(asking, some, width, local_negatives), ["anchor_id", "positive_id"], NEGATIVES)
    return found.select("anchor_id", "positive_id", F.col("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
