"""Line dedup that can be undone: sharded cuckoo filters in front of exact reference counts.

A line's key is the line without blanks at both ends and with A-Z in lower case; keys shorter than
`LEAST` code points are no keys. The index keeps, in a shared folder,

* postings: the documents that hold a key, as 128-bit digests of keys and ids of documents,
* counts: the number of documents that hold a key and the largest of their ids,
* filters: per shard of the key space a cuckoo filter of the keys that are held at all.

Inserting documents appends their postings and sums their keys. A key that the filter of its shard doesn't
know is new, and its count is written without looking at the exact table; only the others are joined to it.
Deleting documents counts the keys they held anew from the postings that are left, and takes keys that
nobody holds any more out of the filters. Both append one generation and write its commit row last, so a
job that died leaves nothing that counts, and can be run again. `compact` writes everything as one
generation, with as many shards as the keys need; insertions do so when shards get too full.

Keys are counted before they are shuffled, so a line that a third of all documents hold is a count per
task. A shard holds a bounded number of distinct keys. Repeated keys are joined to the postings by Spark,
which is given a broadcast only after counting them. There is one writer at a time.

Defined cases: a null or empty text is one empty line. Rows that repeat an id within an insertion are one
document for counting and for the largest id, and each row is returned. Documents whose id the index holds
are not inserted again. A null id is an id of its own, smaller than all others. Ids of any type that can be
ordered work. An empty table inserts nothing. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.llm.common import broadcast_if_small, stored
from wardlake.llm.cuckoo import Cuckoo, buckets_for
from wardlake.llm.flat import parts, release_memory

LEAST = 20
MIN_DOCS = 3
KEYS_PER_SHARD = 100_000
SLICE = 4_000_000
BLANKS = b" \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]
COMMIT = "gen int, base int, bits int, keys bigint, deletions boolean, of string"
FILTER = "shard int, filter binary"
RESULT = T.StructType().add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")


def line_key(line: bytes) -> bytes | None:
    """The digest of a line's key; None for a short one."""
    key = line.lower().strip(BLANKS)  # bytes.lower changes A-Z alone
    if len(key) < LEAST or len(key) < 4 * LEAST and len(key.decode()) < LEAST:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for start, stop in parts(sizes, SLICE):
            rows, keys = [], []
            for row, text in enumerate(texts.slice(start, stop - start).to_pylist(), start):
                held = {line_key(line) for line in text.split(b"\n")} - {None}
                rows.extend([row] * len(held))
                keys.extend(held)
            halves = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc_id", *KEY])
    release_memory()


def postings_of(docs: DataFrame) -> DataFrame:
    """(doc_id, hi, lo): the keys of every row, each once a row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_post, f"doc_id {kind}, hi bigint, lo bigint")


def without_lines(text: str | None, dropped: list[dict] | None) -> tuple[int, int, str]:
    """Number of lines, number of dropped ones, and the text of the others."""
    lines = (text or "").encode().split(b"\n")
    gone = {(d["hi"], d["lo"]) for d in dropped or ()}
    kept = []
    for line in lines:
        key = line_key(line)
        if key is None or tuple(np.frombuffer(key, ">i8").tolist()) not in gone:
            kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


@F.arrow_udf(RESULT)
def drop_lines(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    rows = [without_lines(t.as_py(), d.as_py()) for t, d in zip(texts, dropped)]
    kinds = [pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.StructArray.from_arrays(columns, RESULT.names)


def shard_of(hi: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hi, 64 - bits).cast("int") if bits else F.lit(0)


class LineIndex:
    """The index below `path`, a folder that all executors share; `ids` is the type of document ids."""

    def __init__(self, spark: SparkSession, path: str, keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.path, self.keys_per_shard = spark, path, keys_per_shard

    # -- generations

    def commits(self) -> list:
        """Commit rows of the generations that count, oldest first."""
        try:
            rows = self.spark.read.schema(COMMIT).json(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        rows.sort(key=lambda r: r.gen)
        return [r for r in rows if r.gen >= rows[-1].base]

    def _write(self, table: str, gen: int, rows: DataFrame) -> DataFrame:
        folder = f"{self.path}/{table}/gen={gen}"
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _read(self, table: str, commits: list) -> DataFrame:
        """All rows of a table, with the generation each was written in."""
        folders = [f"{self.path}/{table}/gen={c.gen}" for c in commits]
        rows = self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*folders)
        return rows.withColumn("gen", F.col("gen").cast("int"))

    def _commit(self, gen: int, base: int, bits: int, keys: int, deletions: bool, of: str) -> None:
        row = self.spark.createDataFrame([(gen, base, bits, keys, deletions, of)], COMMIT)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/gen={gen}")

    # -- tables

    def _counts(self, commits: list) -> DataFrame:
        """(hi, lo, n, largest) of every key that is held; a later generation replaces an earlier one."""
        rows = self._read("counts", commits)
        if len(commits) > 1:
            newest = F.max_by(F.struct("n", "largest"), "gen").alias("row")
            rows = rows.groupBy(*KEY).agg(newest).select(*KEY, "row.*")
        return rows.filter("n > 0").select(*KEY, "n", "largest")

    def _filters(self, commits: list) -> DataFrame:
        rows = self._read("filters", commits)
        return rows.groupBy("shard").agg(F.max_by("filter", "gen").alias("filter"))

    def _documents(self, commits: list) -> DataFrame:
        """(doc_id, gen): the held documents and the generation of their postings."""
        newest = F.max_by("held", "gen").alias("held")
        rows = self._read("docs", commits).groupBy("doc_id").agg(newest, F.max("gen").alias("gen"))
        return rows.filter("held").select("doc_id", "gen")

    def _postings(self, commits: list) -> DataFrame:
        """(doc_id, hi, lo) of the held documents."""
        rows = self._read("postings", [c for c in commits if c.of != "delete"])
        if any(c.deletions for c in commits):
            held = self._documents(commits).select(F.col("doc_id").alias("id"), F.col("gen").alias("of"))
            same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("gen") == F.col("of"))
            rows = rows.join(held, same, "left_semi")
        return rows.select("doc_id", *KEY)

    # -- filters

    def _changed_filters(self, changes: DataFrame, bits: int, held: DataFrame | None) -> DataFrame:
        """New filters of the shards with changes (hi, lo, added)."""
        buckets = buckets_for(self.keys_per_shard)
        names = ["shard", "filter"]

        def change(shard: int, keys: pa.Table, old: pa.Table | None) -> pa.Table:
            data = old.column("filter")[0].as_py() if old is not None and old.num_rows else None
            table = Cuckoo(buckets, data)
            lo, added = (keys.column(c).to_numpy() for c in ("lo", "added"))
            table.delete(lo[~added])
            table.insert(lo[added])
            return pa.table([pa.array([shard], pa.int32()), pa.array([table.tobytes()], pa.binary())], names)

        keys = changes.select(shard_of(F.col("hi"), bits).alias("shard"), "lo", "added").groupBy("shard")
        if held is None:
            return keys.applyInArrow(lambda key, rows: change(key[0].as_py(), rows, None), FILTER)

        def both(key: tuple, rows: pa.Table, old: pa.Table) -> pa.Table:
            if rows.num_rows:
                return change(key[0].as_py(), rows, old)
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.binary())], names)

        return keys.cogroup(held.groupBy("shard")).applyInArrow(both, FILTER)

    def _probed(self, keys: DataFrame, bits: int, held: DataFrame, names: list[str]) -> DataFrame:
        """The keys, with whether the filter of their shard may hold them."""
        buckets = buckets_for(self.keys_per_shard)

        def probe(key: tuple, rows: pa.Table, old: pa.Table) -> pa.Table:
            known = np.zeros(rows.num_rows, bool)
            if old.num_rows and rows.num_rows:
                known = Cuckoo(buckets, old.column("filter")[0].as_py()).contains(rows.column("lo").to_numpy())
            return rows.select(names).append_column("known", pa.array(known, pa.bool_()))

        rows = keys.withColumn("shard", shard_of(F.col("hi"), bits))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.select(*names).schema)
        return rows.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(probe, f"{schema}, known boolean")

    def known_keys(self, docs: DataFrame) -> DataFrame:
        """(doc_id, hi, lo, known): keys of documents, and whether the filters may hold them."""
        commits = self.commits()
        keys = postings_of(docs)
        if not commits:
            return keys.withColumn("known", F.lit(False))
        distinct = stored(keys.select(*KEY).distinct(), "line-keys")
        probed = self._probed(distinct, commits[-1].bits, self._filters(commits), KEY)
        return keys.join(probed, KEY)

    # -- changes

    def insert(self, docs: DataFrame) -> None:
        """Add the documents (doc_id, text) whose id is not held yet."""
        commits = self.commits()
        gen = commits[-1].gen + 1 if commits else 0
        rows = docs.select("doc_id", "text")
        if commits:
            held = self._documents(commits).select(F.col("doc_id").alias("id"))
            rows = rows.join(held, F.col("doc_id").eqNullSafe(F.col("id")), "left_anti")
        new = self._write("docs", gen, rows.select("doc_id").distinct().withColumn("held", F.lit(True)))
        posted = postings_of(rows)
        if new.count() < rows.count():  # rows that share an id may share keys
            posted = posted.distinct()
        posted = self._write("postings", gen, posted)
        summed = posted.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("largest"))
        batch = ["hi", "lo", "n", "largest"]
        if not commits:
            counts = self._write("counts", gen, summed)
            keys = counts.count()
            bits = self.bits_for(keys)
            changes = counts.select(*KEY, F.lit(True).alias("added"))
            self._write("filters", gen, self._changed_filters(changes, bits, None))
            self._commit(gen, gen, bits, keys, False, "insert")
            return
        bits = commits[-1].bits
        held = self._filters(commits)
        probed = stored(self._probed(stored(summed, "line-sums"), bits, held, batch), "line-probes")
        before = self._counts(commits).withColumnsRenamed({"n": "n_before", "largest": "largest_before"})
        met = probed.filter("known").join(before, KEY, "left").select(
            *KEY,
            (F.col("n") + F.coalesce("n_before", F.lit(0))).alias("n"),
            F.greatest("largest", "largest_before").alias("largest"),
            F.col("n_before").isNull().alias("added"),
        )
        fresh = probed.filter("not known").select(*batch, F.lit(True).alias("added"))
        counts = self._write("counts", gen, fresh.unionByName(met))
        added = counts.filter("added").select(*KEY, "added")
        keys = commits[-1].keys + added.count()
        self._write("filters", gen, self._changed_filters(added, bits, held))
        self._commit(gen, commits[0].base, bits, keys, False, "insert")
        if keys > self.keys_per_shard << bits:
            self.compact()

    def delete(self, ids: DataFrame) -> None:
        """Take the documents with these ids (column doc_id) out of the index; unknown ids are ignored."""
        commits = self.commits()
        if not commits:
            return
        gen = commits[-1].gen + 1
        wanted = ids.select(F.col("doc_id").alias("id")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("id"))
        gone = self._documents(commits).join(wanted, same, "left_semi").select("doc_id", F.lit(False).alias("held"))
        gone = self._write("docs", gen, gone).select(F.col("doc_id").alias("id"))
        postings = self._postings(commits)
        touched = stored(postings.join(gone, same, "left_semi").select(*KEY).distinct(), "line-touched")
        left = postings.join(touched, KEY, "left_semi").join(gone, same, "left_anti")
        left = left.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("largest"))
        # the counts as they are now, not less than before: a deletion that is run again does no harm
        now = touched.join(left, KEY, "left").select(*KEY, F.coalesce("n", F.lit(0)).alias("n"), "largest")
        counts = self._write("counts", gen, now)
        free = counts.filter("n = 0").select(*KEY, F.lit(False).alias("added"))
        self._write("filters", gen, self._changed_filters(free, commits[-1].bits, self._filters(commits)))
        self._commit(gen, commits[0].base, commits[-1].bits, commits[-1].keys - free.count(), True, "delete")

    def compact(self) -> None:
        """Write what is held as one generation, with as many shards as its keys need."""
        commits = self.commits()
        if not commits:
            return
        gen = commits[-1].gen + 1
        self._write("docs", gen, self._documents(commits).select("doc_id", F.lit(True).alias("held")))
        self._write("postings", gen, self._postings(commits))
        counts = self._write("counts", gen, self._counts(commits))
        bits = self.bits_for(commits[-1].keys)
        changes = counts.select(*KEY, F.lit(True).alias("added"))
        self._write("filters", gen, self._changed_filters(changes, bits, None))
        self._commit(gen, gen, bits, commits[-1].keys, False, "compact")

    def bits_for(self, keys: int) -> int:
        """Bits of the shard number: shards are on average no more than full."""
        return max(0, -(-keys // self.keys_per_shard) - 1).bit_length()

    # -- results

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(hi, lo, n, largest) of the keys that at least `min_docs` documents hold."""
        return self._counts(self.commits()).filter(F.col("n") >= min_docs)

    def dropped(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, hi, lo): the repeated keys each document loses, which is all but the largest's."""
        repeated = broadcast_if_small(stored(self.repeated(min_docs).select(*KEY, "largest"), "line-repeats"))
        held = self._postings(self.commits()).join(repeated, KEY)
        return held.filter(~F.col("doc_id").eqNullSafe(F.col("largest"))).select("doc_id", *KEY)


def drop_repeated(docs: DataFrame, index: LineIndex, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every row, by the documents the index holds."""
    rows = docs.select("doc_id", "text")
    if not index.commits():
        return rows.select("doc_id", drop_lines("text", F.lit(None).cast("array<struct<hi:bigint,lo:bigint>>")).alias("r")).select("doc_id", "r.*")
    lists = index.dropped(min_docs).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct(*KEY)).alias("gone"))
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    # a text that loses nothing stays in the JVM
    changed = F.col("gone").isNotNull()
    text = F.coalesce("text", F.lit(""))
    result = joined.withColumn("r", drop_lines(F.when(changed, F.col("text")), F.col("gone")))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return result.select(
        "doc_id",
        F.when(changed, F.col("r.n_lines")).otherwise((breaks + 1).cast("bigint")).alias("n_lines"),
        F.when(changed, F.col("r.n_dropped")).otherwise(F.lit(0).cast("bigint")).alias("n_dropped"),
        F.when(changed, F.col("r.kept_text")).otherwise(text).alias("kept_text"),
    )
