"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into windows of `window` consecutive words; an item of fewer words is
one window. A window is the set of its word shingles at their offsets. A document contains a window
only if it holds all of the window's shingles, so under a global order by rarity in the corpus the
rarest shingle alone is the necessary prefix. Every text is cut into words and shingles once, and the
places of shingles that some window has are written to the shared folder. Their counts give the order,
the places of prefix shingles are the candidates, the position and length bounds place the window, and
the words at that place, cut again only for documents with candidates, are compared exactly.

Defined cases: null or wordless texts have no words, windows or hits; wordless items match nothing.
Rows with the same id and text are judged alike and each is returned. A null id is an id of its own.
Extra columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import ascii_lower, broadcast_if_small, stored
from wardlake.session import unused

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3


def words_of(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def shingles(words: Column, n: int) -> Column:
    """Hashes of all runs of n words, in order; empty where there are fewer words."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(F.lit(n), *[F.get(words, i + k) for k in range(n)]),
    )
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, window_text, window_size), one row per distinct window of an item."""
    words = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words"))
    sized = words.filter(F.size("words") > 0).withColumn(
        "window_size", F.least(F.size("words"), F.lit(window))
    )
    placed = sized.withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("window_size") + 1))
    )
    run = F.slice("words", F.col("at"), F.col("window_size"))
    return placed.select("item_id", F.array_join(run, " ").alias("window_text"), "window_size").distinct()


def window_shingles(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(window_text, window_size, offset, shingle): all shingles of the distinct windows."""
    distinct = windows.select("window_text", "window_size").distinct().withColumn("words", F.split("window_text", " "))
    words = F.col("words")
    own = F.lit(None).cast("array<bigint>")
    for n in lengths:
        own = F.when(F.least(F.col("window_size"), F.lit(SHINGLE)) == n, shingles(words, n)).otherwise(own)
    return distinct.select("window_text", "window_size", F.posexplode(own).alias("offset", "shingle"))


def shingle_places(docs: DataFrame, tokens: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, print, at, shingle, n_words): places of the known shingles, and a row without a place per document."""
    words = docs.select("id", "print", words_of(F.col("text")).alias("words"))
    whole = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("bigint").alias("shingle"))
    # a position counts within the shingles of its own length
    runs = [
        F.transform(shingles(F.col("words"), n), lambda h, i: F.struct(i.alias("at"), h.alias("shingle"))) for n in lengths
    ]
    rows = words.select("id", "print", F.size("words").alias("n_words"), F.inline(F.concat(F.array(whole), *runs)))
    known = broadcast_if_small(tokens.select("shingle").distinct()).withColumn("known", F.lit(True))
    return rows.join(known, "shingle", "left").filter("known or at < 0").drop("known")


def placed_windows(docs: DataFrame, places: DataFrame, tokens: DataFrame) -> DataFrame:
    """(id, print, window_text, start, stop): every occurrence of a window in a document."""
    found = places.filter("at >= 0")
    rarity = found.groupBy("shingle").agg(F.count("*").alias("seen"))
    # no document holds a window with a shingle that was never seen
    rarest = F.min(F.struct("seen", "offset", "shingle"))
    prefix = (
        tokens.join(rarity, "shingle", "left")
        .withColumn("seen", F.coalesce("seen", F.lit(0)))
        .groupBy("window_text", "window_size")
        .agg(rarest.alias("rarest"))
        .filter("rarest.seen > 0")
        .select("window_text", "window_size", "rarest.offset", "rarest.shingle")
    )
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("window_size") <= F.col("n_words"))
    candidates = found.join(broadcast_if_small(stored(prefix, "prefixes")), "shingle").filter(inside)
    candidates = candidates.select("id", "print", start.alias("start"), "window_size", "window_text").distinct()
    candidates = stored(candidates, "candidates")
    named = candidates.select(F.col("id").alias("id_"), F.col("print").alias("print_")).distinct()
    named = broadcast_if_small(stored(named, "candidate-documents"))
    own = docs.join(named, docs["id"].eqNullSafe(F.col("id_")) & (docs["print"] == F.col("print_")), "left_semi")
    words = own.dropDuplicates(["id", "print"]).select(
        F.col("id").alias("id_"), F.col("print").alias("print_"), words_of(F.col("text")).alias("words")
    )
    by_row = F.col("id").eqNullSafe(F.col("id_")) & (F.col("print") == F.col("print_"))
    same = F.array_join(F.slice("words", F.col("start") + 1, F.col("window_size")), " ") == F.col("window_text")
    stop = (F.col("start") + F.col("window_size")).alias("stop")
    return candidates.join(words, by_row).filter(same).select("id", "print", "window_text", "start", stop)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: doc_id, print, n_words, n_hit, items (sorted), contaminated.

    `print` is a hash of the text; with doc_id it names the rows that share a judgement.
    """
    print_ = F.xxhash64(F.col(text)).alias("print")
    source = docs.select(F.col(doc_id).alias("id"), print_, F.col(text).alias("text"))
    windows = item_windows(items, item_id, item_text, window)
    size = F.least(F.col("window_size"), F.lit(SHINGLE))
    lengths = sorted(r[0] for r in windows.select(size).distinct().collect())  # 1 to SHINGLE
    tokens = window_shingles(windows, lengths)
    places = stored(shingle_places(source, tokens, lengths), "shingles")
    placed = stored(placed_windows(source, places, tokens), "windows")
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "stop"))),
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda acc, x: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], acc["reach"]))).alias("hit"),
            F.greatest(acc["reach"], x["stop"]).alias("reach"),
        ),
    )
    hits = placed.groupBy("id", "print").agg(covered["hit"].cast("bigint").alias("n_hit"))
    named = (
        placed.select("id", "print", "window_text")
        .distinct()
        .join(windows.select("window_text", "item_id"), "window_text")
        .groupBy("id", "print")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    found = hits.join(named, hits["id"].eqNullSafe(named["id"]) & (hits["print"] == named["print"]), "left").select(
        hits["id"].alias("id_"), hits["print"].alias("print_"), "n_hit", "items"
    )
    rows = places.filter("at < 0").select("id", "print", F.col("n_words").cast("bigint").alias("n_words"))
    return rows.join(found, rows["id"].eqNullSafe(found["id_"]) & (rows["print"] == found["print_"]), "left").select(
        F.col("id").alias(doc_id),
        "print",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    judged = contamination(docs, items, doc_id, text, **names)
    id_, print_ = unused(docs, "id", "print")
    bad = judged.filter("contaminated").select(F.col(doc_id).alias(id_), F.col("print").alias(print_)).distinct()
    bad = broadcast_if_small(stored(bad, "contaminated"))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(id_)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(print_))
    return docs.join(bad, same, "left_anti")
