"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

Documents with the same shingle set form one class. A class has a signature of `coordinates` minimum
hashes and is posted under each (coordinate, value) pair. Two classes link if they agree in at least
`agree` coordinates and their full sets confirm the similarity. Lists are merged by threshold:

* Prefix: pairs that only one class has cannot agree with anything and are not joined. Of the
  s shared pairs of a class, ordered by list length, agreement in `agree` of them needs at least one
  of the s - agree + 1 rarest; a class with s < agree has no partner at all.
* Skip: the long lists behind the prefix are never merged. Pairs from the prefix lists count their
  agreements on the two signatures.
* In a list, every class is first compared with the list's most common class, the one whose keys
  have the longest lists; in a group of copies that is the text they stem from. Links found so join
  classes to components. Only classes outside their list's largest component are then compared with
  all members of other components, so no link between components is missed.
* Both comparisons only pass on pairs whose set sketches allow the similarity. A sketch has a bit for
  each hash bucket, set if an odd number of shingles falls there. Two sketches never differ in more
  bits than the sets differ in shingles, so no pair at or above the similarity is ruled out.

A pair of similarity s agrees in a binomial(coordinates, s) number of coordinates; with 64 and 36 a
pair at exactly 0.8 is missed once in about 200,000 times. Confirmation is on full sets, so nothing
wrong is linked.

Defined cases: null and wordless texts have no shingles and stand alone. Fewer words than a shingle
make one shingle of all words. The component id is the smallest non-null id of the component, or null
if it has none. The kept row of a component is the one with that id and the smallest hash of its text
(`print`); rows that repeat both id and text share its verdict. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import broadcast_if_small, stored
from wardlake.llm.flat import chunks, mixed, multipliers, release_memory, run_hashes, split_words
from wardlake.llm.graph import BROADCAST_NODES, components, joined_components
from wardlake.session import unused

WORDS = 5
SIMILARITY = (8, 10)
COORDINATES = 64
AGREE = 36
ROWS_AT_ONCE = 4096
SKETCH_BITS = 512
HEAD = "struct(id is null as unnamed, id, print)"  # rows with an id come first


def shingle_sets(texts: pa.Array | list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text, in order."""
    for _, part in chunks(texts):
        flat = split_words(part)
        for i in range(len(part)):
            yield np.unique(run_hashes(flat.hash[flat.first[i] : flat.first[i + 1]], words))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Minimum of each of several hash functions over the set."""
    factors = multipliers(coordinates, salt=977)
    low = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), ROWS_AT_ONCE):
        # the high bits of a product depend on all bits of the shingle
        low = np.minimum(low, (shingles[k : k + ROWS_AT_ONCE, None] * factors).min(axis=0))
    return low


def sketch(shingles: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity of the number of shingles in each of `bits` buckets, packed into 64-bit words."""
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_reach(a: str, b: str, ratio: tuple[int, int], words: int = SKETCH_BITS // 64) -> Column:
    """Whether sketches and sizes of two sets (struct columns `sketch`, `size`) allow the similarity.

    Sets of similarity s differ in (1 - s) / (1 + s) of the sum of their sizes.
    """
    differ = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(words)), F.lit(0))
    total = F.col(f"{a}.size") + F.col(f"{b}.size")
    return differ * (ratio[1] + ratio[0]) <= total * (ratio[1] - ratio[0])


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """id, print, n_shingles, class (digest of the set; null if empty), signature and sketch of every row."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("print", pa.int64()),
            ("n_shingles", pa.int64()),
            ("class", pa.binary()),
            ("signature", pa.list_(pa.int64())),
            ("sketch", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, classes, signed, sketched = [], [], [], []
            for shingles in shingle_sets(batch.column("text"), words):
                counts.append(len(shingles))
                some = len(shingles) > 0
                classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if some else None)
                signed.append(signature(shingles, coordinates).view(np.int64) if some else None)
                sketched.append(sketch(shingles) if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("print"),
                    pa.array(counts, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(signed, pa.list_(pa.int64())),
                    pa.array(sketched, pa.list_(pa.int64())),
                ],
                schema=schema,
            )
        release_memory()

    out = "id bigint, print bigint, n_shingles bigint, class binary, signature array<bigint>, sketch array<bigint>"
    return docs.select("id", "print", "text").mapInArrow(run, out)


def prefix_postings(classes: DataFrame, agree: int) -> DataFrame:
    """(key, class, common, of): classes under their rarest shared keys, as many as `agree` makes necessary.

    `common` says how long the lists of a class are in all; `of` holds its sketch and set size.
    """
    posted = classes.select("class", F.posexplode("signature").alias("coordinate", "value")).select(
        "class", F.xxhash64("coordinate", "value").alias("key")
    )
    lengths = posted.groupBy("key").agg(F.count("*").alias("length")).filter("length > 1")
    shared = posted.join(lengths, "key").groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct("length", "key"))).alias("keys")  # one per coordinate at most
    )
    prefix = F.slice("keys.key", 1, F.size("keys") - agree + 1)
    common = F.aggregate("keys.length", F.lit(0).cast("bigint"), lambda total, n: total + n)
    chosen = shared.filter(F.size("keys") >= agree).select("class", common.alias("common"), prefix.alias("keys"))
    of = F.struct("sketch", F.col("n_shingles").alias("size")).alias("of")
    return chosen.join(classes.select("class", of), "class").select("class", "common", "of", F.explode("keys").alias("key"))


def leader_pairs(postings: DataFrame, plausible: Column) -> DataFrame:
    """(a, b): every class with the most common class of each of its lists, where `plausible`.

    `plausible` compares the struct columns `x` and `y`, the `of` of both.
    """
    most = F.max_by(F.struct(F.col("class").alias("a"), F.col("of").alias("x")), F.struct("common", "class"))
    leaders = postings.groupBy("key").agg(most.alias("lead")).select("key", "lead.*")
    pairs = postings.withColumnRenamed("of", "y").join(leaders, "key").filter(F.col("a") != F.col("class"))
    ordered = pairs.filter(plausible).select(F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b"))
    return ordered.distinct()


def residual_pairs(postings: DataFrame, labels: DataFrame, plausible: Column) -> DataFrame:
    """(a, b) across components within a list, unless both are in its largest component."""
    node = broadcast_if_small(labels.select(F.col("node").alias("class"), "component"), BROADCAST_NODES)
    labelled = postings.join(node, "class", "left").withColumn("component", F.coalesce("component", "class"))
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("members", "component")).alias("largest"), F.count("*").alias("parts")
    )
    several = broadcast_if_small(stored(largest.filter("parts > 1").drop("parts"), "several"))
    mixed_lists = labelled.join(several, "key")
    outer = mixed_lists.filter("component <> largest").select(
        "key", F.col("class").alias("a"), F.col("component").alias("ca"), F.col("of").alias("x")
    )
    every = mixed_lists.select("key", F.col("class").alias("b"), F.col("component").alias("cb"), F.col("of").alias("y"))
    # a pair of two outer classes comes up from both sides, but only once as distinct rows
    pairs = outer.join(every, (outer["key"] == every["key"]) & (F.col("ca") != F.col("cb")) & plausible)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def agreeing(pairs: DataFrame, classes: DataFrame, agree: int, ratio: tuple[int, int]) -> DataFrame:
    """Pairs whose signatures agree often enough and whose set sizes allow the similarity."""
    size = F.col("n_shingles")
    side = classes.select("class", "signature", size.alias("size"))
    a = side.select(F.col("class").alias("a"), F.col("signature").alias("sa"), F.col("size").alias("na"))
    b = side.select(F.col("class").alias("b"), F.col("signature").alias("sb"), F.col("size").alias("nb"))
    near = (F.least("na", "nb") * ratio[1]) >= (F.greatest("na", "nb") * ratio[0])
    both = pairs.join(a, "a").join(b, "b").filter(near)
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda e: e))
    return both.filter(same >= agree).select("a", "b")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, ratio: tuple[int, int]) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    pairs = stored(pairs, "pairs")
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    rows = broadcast_if_small(stored(classes.join(needed, "class").select("class", "rep"), "needed"))
    wanted = rows.select("class", F.col("rep.id").alias("rep_id"), F.col("rep.print").alias("rep_print"))
    at = docs["id"].eqNullSafe(wanted["rep_id"]) & (docs["print"] == wanted["rep_print"])
    texts = docs.join(wanted, at).select("class", "text")
    texts = texts.dropDuplicates(["class"])  # rows may repeat
    both = (
        pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = shingle_sets(batch.column("ta"), words)
            right = shingle_sets(batch.column("tb"), words)
            good = []
            for x, y in zip(left, right):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common * ratio[1] >= (len(x) + len(y) - common) * ratio[0])
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
        release_memory()

    return both.mapInArrow(check, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    coordinates: int = COORDINATES,
    agree: int = AGREE,
) -> DataFrame:
    """One row per document: its id, print, n_shingles, component_id and kept.

    `similarity` is a fraction (numerator, denominator) of whole numbers.
    """
    source = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(F.col(text)).alias("print"),
        F.col(text).alias("text"),
    )
    rows = stored(signatures(source, words, coordinates), "signatures")
    members = rows.filter("class is not null")
    # of equal sets the signatures are equal, so any will do
    classes = stored(
        members.groupBy("class").agg(
            F.min(F.struct("id", "print")).alias("rep"),
            F.min(F.expr(HEAD)).alias("head"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    postings = stored(prefix_postings(classes, agree), "postings")
    plausible = may_reach("x", "y", similarity)
    first = confirmed(agreeing(leader_pairs(postings, plausible), classes, agree, similarity), source, classes, words, similarity)
    linked = components(first)
    rest = residual_pairs(postings, linked, plausible)
    second = confirmed(agreeing(rest, classes, agree, similarity), source, classes, words, similarity)
    labels = joined_components(linked, second).select(F.col("node").alias("class"), "component")
    named = classes.select("class", "head").join(broadcast_if_small(stored(labels, "labels"), BROADCAST_NODES), "class", "left")
    part = named.select("class", "head", F.coalesce("component", "class").alias("component"))
    heads = part.groupBy("component").agg(F.min("head").alias("kept_head"))
    by_class = part.join(heads, "component").select("class", "kept_head")
    judged = rows.select("id", "print", "n_shingles", "class").join(by_class, "class", "left")
    head = F.coalesce("kept_head", F.expr(HEAD))
    return judged.select(
        F.col("id").alias(doc_id),
        "print",
        "n_shingles",
        head["id"].alias("component_id"),
        head.eqNullSafe(F.expr(HEAD)).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns; of rows equal in id and text, one."""
    judged = stored(near_duplicates(docs, doc_id, text, **options), "judged")
    id_, print_ = unused(docs, "id", "print")
    key = judged.select(F.col(doc_id).alias(id_), F.col("print").alias(print_), "kept")
    same = F.col(f"`{doc_id}`").cast("bigint").eqNullSafe(F.col(id_)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(print_))
    again = stored(key.filter("kept").groupBy(id_, print_).count().filter("count > 1").drop("count"), "again")
    gone = key.filter("not kept").select(id_, print_).distinct()
    single = docs.join(broadcast_if_small(stored(gone.union(again), "gone")), same, "left_anti")
    if again.isEmpty():
        return single
    return single.union(docs.join(again, same, "left_semi").dropDuplicates([doc_id, text]))
