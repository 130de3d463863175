"""How filters interact: what each removes, repeats and costs in every order they could run in.

Each document is judged once by all filters, which gives it a mask of the filters it fails. Documents
are counted by mask, part and label, and all orders are judged on these counts alone. A filter's place
in an order is read from the inverse of the permutation. The step at which an order removes a mask is
the min-plus product of the mask matrix (0 where the filter fails, else infinite) and the matrix of
places: the smallest place of a failing filter. Scattering the counts by that step gives what each step
removes, and comparing it with the step of a filter gives what is redundant.

One filter looks at the whole table: a copy fails if the same text stands under a smaller id. Texts meet
by 128-bit digests of which each task and group sends counts and its smallest id, so a text that a third
of all rows share is combined before the shuffle. The number of masks is fixed, so the matrices of one
part have a fixed size and parts are judged side by side.

Defined cases: a null text is an empty one, and so has no words; all empty texts are copies of each other.
A null source is the part with the empty name. Rows that repeat an id are rows of their own; of equal
texts all rows with the smallest id stay. A null id is neither smaller nor larger than another: its row is
no copy and makes none. Labels that repeat an id count as set if one of them is; a document without a
label has none set. An empty table has no parts. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import stored
from wardlake.llm.flat import parts

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_UPPER = 5
UPPER = string.ascii_uppercase.encode()
SIGNS = b"#$%&*|"
SLICE = 4_000_000
WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_mask(text: bytes, points: int) -> int:
    """The filters A to D, as bits, that a text fails."""
    words = text.split()
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * (len(text) - len(text.translate(None, UPPER))) > MOST_UPPER * points,
        len(text) > len(text.translate(None, SIGNS)),
    )
    return sum(fail << k for k, fail in enumerate(fails))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        points = pc.utf8_length(texts).to_pylist()
        raw = texts.cast(pa.binary())
        masks: list[int] = []
        digests: list[bytes] = []
        for start, stop in parts(pc.binary_length(texts).to_numpy(zero_copy_only=False), SLICE):
            for text, n in zip(raw.slice(start, stop - start).to_pylist(), points[start:stop]):
                masks.append(own_mask(text, n))
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "part", "mask", "digest"],
        )


def failing(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of every row; the mask has the filters that look at one text."""
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_judge, f"doc_id {kind}, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows by the filters they fail, the copy filter among them."""

    def is_set(name: str) -> Column:
        return F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(name)

    labelled = labels.filter("doc_id is not null").groupBy("doc_id").agg(is_set("quality"), is_set("toxic"))
    known = failing(docs).join(labelled, "doc_id", "left").fillna(False, ["quality", "toxic"])
    text = ["digest", "mask", "part", "quality", "toxic"]
    named = F.col("doc_id").isNotNull()
    same = known.groupBy(*text, "doc_id").agg(F.count("*").alias("n"))
    groups = stored(
        same.groupBy(*text).agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("unnamed"),
            F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"),
        ),
        "audit-texts",
    )
    lowest = groups.groupBy("digest").agg(F.min("first.doc_id").alias("lowest"))
    firsts = F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    stays = F.col("unnamed") + firsts
    split = F.array(
        F.struct(F.col("mask").alias("mask"), stays.alias("n")),
        F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), (F.col("n") - stays).alias("n")),
    )
    judged = groups.join(lowest, "digest").select("part", "quality", "toxic", F.inline(split))

    def of(label: str) -> Column:
        return F.sum(F.when(F.col(label), F.col("n")).otherwise(0))

    return judged.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), of("quality").alias("good"), of("toxic").alias("toxic")
    )


def fail_matrix(n_filters: int) -> np.ndarray:
    """Row per mask, column per filter: whether the mask has the filter."""
    return (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1 > 0


def places(orders: np.ndarray) -> np.ndarray:
    """The inverse of each permutation: at which step, from 1, an order has each filter."""
    inverse = np.empty_like(orders)
    np.put_along_axis(inverse, orders, np.arange(1, orders.shape[1] + 1)[None, :], axis=1)
    return inverse


def removal_steps(fails: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Min-plus product: the step at which each order removes each mask, or one past the last."""
    never = place.shape[1] + 1
    cost = np.where(fails, 0, never)
    return np.minimum((cost[:, None, :] + place[None, :, :]).min(axis=2), never)


def audit_counts(weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """All counts of one part, (order, step); `weights` has a row per mask, a column per weight."""
    n_orders, n_filters = orders.shape
    fails, place = fail_matrix(n_filters), places(orders)
    step = removal_steps(fails, place)
    cells = np.arange(n_orders)[None, :] * (n_filters + 2) + step
    lost = np.zeros((n_orders * (n_filters + 2), weights.shape[1]), np.int64)
    for k in range(weights.shape[1]):
        np.add.at(lost[:, k], cells, np.broadcast_to(weights[:, k, None], cells.shape))
    removed, good, toxic = np.moveaxis(lost.reshape(n_orders, n_filters + 2, -1)[:, 1:-1], 2, 0)
    count = weights[:, 0]
    # a mask that fails a filter but was removed before the filter's step
    late = fails[:, None, :] & (step[:, :, None] < place[None, :, :])
    redundant = np.take_along_axis(np.tensordot(count, late, axes=1), orders, axis=1)
    alone = count[1 << np.arange(n_filters)]
    total = np.zeros(n_filters, np.int64)
    np.add.at(total, orders, removed)
    kept = count.sum() - np.cumsum(removed, axis=1)
    return dict(zip(COUNTS, (kept, removed, redundant, alone[orders], good, toxic, total[orders])))


def _tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders = np.array(list(permutations(range(len(FILTERS)))))
    names = ["".join(FILTERS[f] for f in order) for order in orders]
    steps = len(FILTERS)
    rows = len(orders) * steps
    labels = pa.array(np.repeat(names, steps))
    numbers = pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders)))
    for batch in batches:
        for part, held in zip(batch.column("part").to_pylist(), batch.column("held").to_pylist()):
            weights = np.zeros((1 << steps, len(WEIGHTS)), np.int64)
            for row in held:
                weights[row["mask"]] = [row[w] for w in WEIGHTS]
            counts = audit_counts(weights, orders)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * rows), labels, numbers, *[pa.array(counts[c].ravel()) for c in COUNTS]],
                ["part", "filter_order", "step", *COUNTS],
            )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with all counts within the part."""
    counted = mask_counts(docs, labels)
    held = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("held"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return held.mapInArrow(_tabulate, schema)
