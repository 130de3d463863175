"""Hard negatives by exact integer scores from subset-sum tables (the method of Four Russians).

Vectors are scaled and rounded down to whole numbers. A candidate's numbers, in two's complement, are cut
into bit planes, and each plane into bytes of eight dimensions. For an anchor, a table per eight dimensions
holds the sums of all 256 subsets of its numbers there. A plane's inner product with the anchor is then one
lookup per byte, and planes are joined by shift and add, the sign plane negatively: the full exact score.

Candidates are packed once into blocks of bit planes, written to the shared folder and spread over slots.
Anchors are packed into blocks, which are laid into every slot. A pair of blocks is scored at a time and
leaves only the best rows of each anchor, so memory is bounded by two blocks and the rows that are sorted
at the end by the number of blocks. A first pass finds each anchor's positives among the rows of its label,
a second one the negatives whose scores lie between two shares of a positive's score.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Rows that repeat an id count as one, the one with the smallest label and vector. Missing dimensions of
shorter vectors count as 0, so an empty vector has score 0 with all. An anchor without another row of its
label has no positive and no row; a positive with a negative score has an empty range. Ties go by the
smaller id. Ids and labels are whole numbers. Numbers so large that a hundredfold score leaves 64 bits end
the job with an error. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import stored

SCALE = 256
DIMENSIONS = 8
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of the positive's.
BAND = (30, 90)
BLOCK = 2048
ANCHORS = 64
LIMIT = 1 << 62

BLOCK_SCHEMA = "slot int, n int, width int, bits int, ids binary, labels binary, data binary"
ANCHOR_SCHEMA = "n int, width int, ids binary, labels binary, data binary, positives binary, scores binary"


def rounded_down(vectors: pa.Array, scale: int) -> np.ndarray:
    """Row per vector of whole numbers, as wide as the longest, in full groups of dimensions."""
    sizes = np.diff(vectors.offsets.to_numpy())
    width = -(-max(1, int(sizes.max(initial=0))) // DIMENSIONS) * DIMENSIONS
    values = np.floor(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
    if len(values) and np.abs(values).max() >= LIMIT:
        raise OverflowError("vector components are too large for exact scores")
    numbers = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    numbers[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return numbers


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """(plane, row, group of dimensions): bytes of two's complement bits, the sign plane last."""
    low, high = int(numbers.min(initial=0)), int(numbers.max(initial=0))
    bits = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
    return np.stack([np.packbits((numbers >> p & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(bits)])


def subset_sums(numbers: np.ndarray, kind: type) -> np.ndarray:
    """(group of dimensions, subset, anchor): sums over every subset of eight dimensions."""
    groups = numbers.T.reshape(-1, DIMENSIONS, len(numbers)).astype(kind)
    tables = np.zeros((len(groups), 1 << DIMENSIONS, len(numbers)), kind)
    for j in range(DIMENSIONS):
        tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + groups[:, j, None]
    return tables


def scores(numbers: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor): exact inner products, one table lookup per byte of the planes."""
    groups = min(numbers.shape[1] // DIMENSIONS, planes.shape[2])
    largest = int(np.abs(numbers.astype(float)).sum(axis=1).max()) << len(planes) if numbers.size else 0
    if largest * 100 >= LIMIT:
        raise OverflowError("vector components are too large for exact scores")
    kind = np.int32 if largest < 1 << 31 else np.int64
    tables = subset_sums(numbers[:, : groups * DIMENSIONS], kind)
    total = np.zeros((planes.shape[1], len(numbers)), kind)
    found = np.empty_like(total)
    for p in range(len(planes) - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[p, :, g], axis=0, out=found)
            if p == len(planes) - 1:
                total -= found
            else:
                total += found
    return total.astype(np.int64)


def _whole(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def _pack_candidates(scale: int, slots: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["slot", "n", "width", "bits", "ids", "labels", "data"]
        kinds = [pa.int32()] * 4 + [pa.binary()] * 3
        for batch in batches:
            for part in _blocks(batch, BLOCK):
                ids, labels = _whole(part.column("vec_id")), _whole(part.column("label"))
                order = np.lexsort((ids, labels))
                planes = bit_planes(rounded_down(part.column("embedding"), scale)[order])
                bits, n, groups = planes.shape
                # the same rows always go to the same slot
                row = (int(ids.min()) % slots, n, groups, bits, ids[order].tobytes(), labels[order].tobytes(), planes.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    return pack


def _pack_anchors(scale: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n", "width", "ids", "labels", "data", "positives", "scores"]
        kinds = [pa.int32()] * 2 + [pa.binary()] * 5
        for batch in batches:
            for part in _blocks(batch, ANCHORS):
                ids, labels = _whole(part.column("vec_id")), _whole(part.column("label"))
                order = np.lexsort((ids, labels))
                numbers = rounded_down(part.column("embedding"), scale)[order]
                found = part.column("positives").to_pylist()
                most = max((len(f) for f in found), default=0)
                near = np.full((2, len(ids), most), -1, np.int64)  # a score below 0 leaves nothing to find
                for i, j in enumerate(order):
                    for k, p in enumerate(found[j]):
                        near[:, i, k] = p["positive_id"], p["positive_score"]
                held = (ids[order], labels[order], numbers, *near)
                row = (len(ids), numbers.shape[1], *[x.tobytes() for x in held])
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    return pack


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Arrays of one pair of blocks at a time: candidates, then anchors."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            n, a = row["n"], row["a_n"]
            planes = np.frombuffer(row["data"], np.uint8).reshape(row["bits"], n, row["width"])
            whole = {k: np.frombuffer(row[k], np.int64) for k in ("ids", "labels", "a_ids", "a_labels")}
            numbers = np.frombuffer(row["a_data"], np.int64).reshape(a, row["a_width"])
            near = [np.frombuffer(row[f"a_{k}"], np.int64).reshape(a, -1) for k in ("positives", "scores")]
            yield whole["ids"], whole["labels"], planes, whole["a_ids"], whole["a_labels"], numbers, *near


def _columns(names: list[str], parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)


def _best_positives(most: int) -> Callable:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, planes, a_ids, a_labels, numbers, _, _ in _pairs(batches):
            kept = []
            for label in np.unique(a_labels):
                own = slice(*np.searchsorted(labels, [label, label + 1]))
                mine = slice(*np.searchsorted(a_labels, [label, label + 1]))
                if own.start == own.stop:
                    continue
                found = scores(numbers[mine], planes[:, own])
                order = np.argsort(-found, axis=0, kind="stable")[: most + 1]
                for k, anchor in enumerate(a_ids[mine]):
                    near = order[:, k][ids[own][order[:, k]] != anchor][:most]
                    kept.append((np.full(len(near), anchor), ids[own][near], found[near, k]))
            yield from _columns(["anchor_id", "positive_id", "positive_score"], kept)

    return best


def _best_negatives(most: int, band: tuple[int, int]) -> Callable:
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, planes, a_ids, a_labels, numbers, positives, near in _pairs(batches):
            low, high = -(-band[0] * near // 100), band[1] * near // 100
            some = near >= 0
            found = scores(numbers, planes)
            least = np.where(some, low, LIMIT).min(axis=1)
            largest = np.where(some, high, -LIMIT).max(axis=1)
            fits = (found >= least) & (found <= largest) & (labels[:, None] != a_labels)
            anchor, row = np.nonzero(fits.T)
            order = np.lexsort((ids[row], -found[row, anchor], anchor))
            anchor, row = anchor[order], row[order]
            falling = -found[row, anchor]
            ends = np.searchsorted(anchor, np.arange(len(a_ids) + 1))
            kept = []
            for a in np.flatnonzero(np.diff(ends)):
                own = falling[ends[a] : ends[a + 1]]
                for k in np.flatnonzero(some[a]):
                    start = np.searchsorted(own, -high[a, k], "left")
                    stop = min(np.searchsorted(own, -low[a, k], "right"), start + most)
                    if start < stop:
                        at = row[ends[a] + start : ends[a] + stop]
                        fixed = [np.full(len(at), x) for x in (a_ids[a], positives[a, k], near[a, k])]
                        kept.append((*fixed, ids[at], found[at, a]))
            yield from _columns(names, kept)

    return best


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, one for each id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    if rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        return rows
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row")).select("vec_id", "row.*")


def _ranked(rows: DataFrame, keys: list[str], score: str, other: str, most: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """For each anchor and positive the hardest negatives, ranked from 1.

    `vectors` has vec_id, label and embedding. An anchor's positives are the best `positives` other rows
    of its label; a negative has another label and a score within `band`, in hundredths of the positive's.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(rows.mapInArrow(_pack_candidates(scale, slots), BLOCK_SCHEMA), "vector-blocks")
    anchors = rows.filter(is_anchor)
    unknown = F.array().cast("array<struct<positive_id:bigint,positive_score:bigint>>")

    def scored(chosen: DataFrame, pick: Callable, schema: str) -> DataFrame:
        packed = chosen.select("vec_id", "label", "embedding", "positives").mapInArrow(_pack_anchors(scale), ANCHOR_SCHEMA)
        packed = packed.select(*[F.col(c).alias(f"a_{c}") for c in packed.columns])
        everywhere = packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        return blocks.join(everywhere, "slot").drop("slot").mapInArrow(pick, schema)

    pair = "anchor_id bigint, positive_id bigint, positive_score bigint"
    first = scored(anchors.withColumn("positives", unknown), _best_positives(positives), pair)
    near = _ranked(first, ["anchor_id"], "positive_score", "positive_id", positives)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    chosen = anchors.join(stored(near, "positives"), "vec_id")
    second = scored(chosen, _best_negatives(negatives, band), f"{pair}, negative_id bigint, negative_score bigint")
    return _ranked(second, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
