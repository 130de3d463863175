"""Language identification by segmentation-marginalised piece unigrams.

The pieces are a fixed public vocabulary in lower case. Every language has a probability per piece;
the probability of a word is the sum over all ways to cut it into pieces, found by a forward pass.
Piece probabilities are learned by expectation maximisation: forward and backward passes give the
expected number of uses of each piece, which Spark adds up per language.

The model is fitted on at most `per_language` documents of each language, those with the smallest
hash of their id. Prediction reads whole texts and nothing but the text.

Words are letters with the letters and marks behind them, by Unicode category, in lower case with a mark in
front. Words of any length are summed as a whole: long ones by logarithms, as their probabilities are too
small for a double. A letter that no piece covers costs the same in every language.

Defined cases: texts that are null or have no letter are `und` with score 0. Ties go to the first
language by name. Without any training document all texts are `und`. Null languages are not learned
from. Repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.common import broadcast_if_small
from wardlake.llm.flat import IntTable, chunks, release_memory
from wardlake.session import unused

UND = "und"
MARK = "▁"
# A word is a letter and the letters and marks behind it; numbers such as "½" are none of these.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ASCII_LETTERS = re.compile(r"[a-z]+")
# A probability of at most so many letters is no smaller than a double can be; longer words are summed as logarithms.
LONGEST = 30
PER_LANGUAGE = 400
SLICES = 64
ROUNDS = 3
SMOOTHING = 0.05
UNKNOWN = 1e-9  # probability of a letter without a piece
CACHED_WORDS = 100_000
WORDS_AT_ONCE = 4_000
CODES = 0x110000


def words_of(text: str) -> list[str]:
    lowered = text.lower()
    return (ASCII_LETTERS if lowered.isascii() else LETTERS).findall(lowered)


@lru_cache(maxsize=4)
def vocabulary(model: bytes) -> list[str]:
    """Distinct lower-case pieces of letters, with or without the mark in front."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = {processor.id_to_piece(i).lower() for i in range(processor.get_piece_size())}
    body = {p for p in pieces if LETTERS.fullmatch(p.removeprefix(MARK))}
    return sorted(body | {MARK})


@dataclass
class Trie:
    """Pieces by their characters: node 0 is the root, `step` finds (node, character) pairs."""

    step: IntTable
    target: np.ndarray
    piece: np.ndarray  # per node, the piece that ends there, or -1
    pieces: int


@lru_cache(maxsize=4)
def trie_of(pieces: tuple[str, ...]) -> Trie:
    children: dict[int, int] = {}
    ends = [-1]
    for number, piece in enumerate(pieces):
        node = 0
        for c in piece:
            key = node * CODES + ord(c)
            if key not in children:
                children[key] = len(ends)
                ends.append(-1)
            node = children[key]
        ends[node] = number
    keys = np.fromiter(children.keys(), np.int64, len(children))
    return Trie(IntTable(keys), np.fromiter(children.values(), np.int64, len(children)), np.array(ends), len(pieces))


@dataclass
class Lattice:
    """All pieces inside some marked words, as edges from a start to a stop position.

    Word w owns the positions first[w] to first[w] + size[w]; edges are sorted by how far their stop
    lies from the word's beginning.
    """

    first: np.ndarray
    size: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray  # the number behind the last piece stands for an unknown letter
    depth: np.ndarray  # where the edges of each stop distance begin


def lattice(words: list[str], trie: Trie) -> Lattice:
    marked = [MARK + w for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    inner = np.arange(len(chars)) - begin[word]
    first = begin + np.arange(len(size))  # one position more than characters
    starts, stops, pieces = [], [], []
    here, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
    covered = np.zeros(len(chars), bool)
    length = 0
    while True:  # to the longest piece
        length += 1
        at = here + length - 1
        inside = inner[here] + length <= size[word[here]]
        here, node, at = here[inside], node[inside], at[inside]
        found = trie.step.find(node * CODES + chars[at])
        here, node = here[found >= 0], trie.target[found[found >= 0]]
        if not len(here):
            break
        whole = trie.piece[node] >= 0
        spot = here[whole]
        starts.append(spot + word[spot])
        stops.append(spot + word[spot] + length)
        pieces.append(trie.piece[node[whole]])
        if length == 1:
            covered[spot] = True
    bare = np.flatnonzero(~covered)
    starts.append(bare + word[bare])
    stops.append(bare + word[bare] + 1)
    pieces.append(np.full(len(bare), trie.pieces))
    start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(pieces)
    distance = stop - first[np.searchsorted(first, start, side="right") - 1]
    order = np.lexsort((stop, distance))
    depth = np.searchsorted(distance[order], np.arange(1, int(size.max()) + 2))
    return Lattice(first, size, start[order], stop[order], piece[order], depth)


def forward(net: Lattice, weight: np.ndarray) -> np.ndarray:
    """Per position and language, the summed probability of all cuts up to it."""
    total = np.zeros((int(net.first[-1] + net.size[-1] + 1), weight.shape[1]))
    total[net.first] = 1.0
    for a, b in zip(net.depth[:-1].tolist(), net.depth[1:].tolist()):
        if a < b:
            stop = net.stop[a:b]
            cut = np.flatnonzero(np.diff(stop, prepend=-1))
            total[stop[cut]] = np.add.reduceat(total[net.start[a:b]] * weight[net.piece[a:b]], cut, axis=0)
    return total


def backward(net: Lattice, weight: np.ndarray) -> np.ndarray:
    """Per position and language, the summed probability of all cuts from it to the word's end."""
    total = np.zeros((int(net.first[-1] + net.size[-1] + 1), weight.shape[1]))
    total[net.first + net.size] = 1.0
    # edges by their distance to the end, so that what lies behind them is complete
    word = np.searchsorted(net.first, net.start, side="right") - 1
    left = net.first[word] + net.size[word] - net.start
    order = np.lexsort((net.start, left))
    start, stop, piece = net.start[order], net.stop[order], net.piece[order]
    bounds = np.searchsorted(left[order], np.arange(1, int(net.size.max()) + 2))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if a < b:
            cut = np.flatnonzero(np.diff(start[a:b], prepend=-1))
            total[start[a:b][cut]] = np.add.reduceat(total[stop[a:b]] * weight[piece[a:b]], cut, axis=0)
    return total


def log_forward(net: Lattice, weight: np.ndarray) -> np.ndarray:
    """Logarithms of `forward`, for words whose probabilities are too small for a double."""
    with np.errstate(divide="ignore"):
        logs = np.log(weight)
    total = np.full((int(net.first[-1] + net.size[-1] + 1), weight.shape[1]), -np.inf)
    total[net.first] = 0.0
    for a, b in zip(net.depth[:-1].tolist(), net.depth[1:].tolist()):
        if a < b:
            stop = net.stop[a:b]
            cut = np.flatnonzero(np.diff(stop, prepend=-1))
            total[stop[cut]] = np.logaddexp.reduceat(total[net.start[a:b]] + logs[net.piece[a:b]], cut, axis=0)
    return total


def word_scores(words: list[str], trie: Trie, weight: np.ndarray) -> np.ndarray:
    """Natural log probability of each word in each language, summed over all its cuts into pieces."""
    scores = np.empty((len(words), weight.shape[1]))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for some, is_long in ((np.flatnonzero(sizes <= LONGEST), False), (np.flatnonzero(sizes > LONGEST), True)):
        if len(some):
            net = lattice([words[i] for i in some.tolist()], trie)
            ends = net.first + net.size
            scores[some] = log_forward(net, weight)[ends] if is_long else np.log(forward(net, weight)[ends])
    return scores


def expected_uses(words: list[str], counts: np.ndarray, trie: Trie, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece per language, given how often each word occurs in each.

    A long word counts as its stretches of `LONGEST` letters, whose probabilities a double can hold.
    """
    counts = np.repeat(counts, [-(-len(w) // LONGEST) for w in words], axis=0)
    words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    net = lattice(words, trie)
    ahead, behind = forward(net, weight), backward(net, weight)
    whole = np.maximum(ahead[net.first + net.size], 1e-300)
    word = np.searchsorted(net.first, net.start, side="right") - 1
    share = ahead[net.start] * weight[net.piece] * behind[net.stop] * (counts / whole)[word]
    return np.stack(
        [np.bincount(net.piece, weights=share[:, g], minlength=trie.pieces + 1) for g in range(weight.shape[1])], axis=1
    )[: trie.pieces]


@dataclass
class Model:
    pieces: tuple[str, ...]
    languages: list[str]
    weight: np.ndarray  # pieces and one row for unknown letters, by language


def with_unknown(weight: np.ndarray) -> np.ndarray:
    return np.vstack([weight, np.full((1, weight.shape[1]), UNKNOWN)])


def training_ids(docs: DataFrame, per_language: int) -> DataFrame:
    """(id, lang) of the documents the model is fitted on, at most `per_language` each.

    Those with the smallest hashes, first within each of `SLICES` slices of a language and then of these.
    """
    ranked = docs.filter("lang is not null and id is not null").select("id", "lang").distinct()
    ranked = ranked.withColumn("hash", F.xxhash64("id")).withColumn("slice", F.pmod("hash", F.lit(SLICES)))
    for keys in (["lang", "slice"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("hash", "id")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
    return ranked.select("id", "lang")


def fit(docs: DataFrame, model: bytes, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Learn from docs (id, text, lang)."""
    pieces = tuple(vocabulary(model))
    chosen = broadcast_if_small(training_ids(docs, per_language))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text or "")
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string())], ["lang", "word"])

    sample = docs.join(chosen, ["id", "lang"]).select("lang", "text")
    counted = sample.mapInArrow(split, "lang string, word string").groupBy("word", "lang").agg(F.count("*").alias("n"))
    counted = counted.persist()
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())  # one per language
    weight = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds if languages else 0):

        def uses(batches: Iterator[pa.RecordBatch], weight=with_unknown(weight)) -> Iterator[pa.RecordBatch]:
            trie, place = trie_of(pieces), {g: i for i, g in enumerate(languages)}
            for batch in batches:
                if not batch.num_rows:
                    continue
                counts = np.zeros((batch.num_rows, len(languages)))
                lang = [place[g] for g in batch.column("lang").to_pylist()]
                counts[np.arange(batch.num_rows), lang] = batch.column("n").to_numpy()
                total = expected_uses(batch.column("word").to_pylist(), counts, trie, weight)  # a batch is bounded
                piece, language = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece, pa.int32()), pa.array(language, pa.int32()), pa.array(total[piece, language])],
                    ["piece", "language", "uses"],
                )

        added = counted.mapInArrow(uses, "piece int, language int, uses double").groupBy("piece", "language").agg(F.sum("uses").alias("uses"))
        total = np.full(weight.shape, SMOOTHING)
        for piece, language, n in added.collect():  # at most one row per piece and language
            total[piece, language] += n
        weight = total / total.sum(axis=0)
    counted.unpersist()
    return Model(pieces, languages, with_unknown(weight))


class Scorer:
    """Log probabilities of texts; remembers a bounded number of words."""

    def __init__(self, model: Model):
        self.trie, self.model = trie_of(model.pieces), model
        self.place: dict[str, int] = {}
        self.score = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        new = sorted(words - self.place.keys())
        if len(self.place) + len(new) > CACHED_WORDS:
            self.place, self.score = {}, self.score[:0]
            new = sorted(words)
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            some = (new[i : i + WORDS_AT_ONCE] for i in range(0, len(new), WORDS_AT_ONCE))
            scores = [word_scores(words, self.trie, self.model.weight) for words in some]
            self.score = np.vstack([self.score, *scores])

    def texts(self, texts: pa.Array) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for _, part in chunks(texts):
            out += self._judge([words_of(text) if self.model.languages else [] for text in part])
        return out

    def _judge(self, texts: list[list[str]]) -> list[tuple[str, float]]:
        self.learn(set().union(*texts))
        judged = []
        for words in texts:
            if not words:
                judged.append((UND, 0.0))
                continue
            total = self.score[[self.place[w] for w in words]].sum(axis=0)
            best = int(total.argmax())
            judged.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return judged


def predict(text: Column, model: Model) -> Column:
    """struct<lang, score> of a text column; the score is the posterior under equal priors."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            judged = scorer.texts(batch)
            yield pa.StructArray.from_arrays(
                [pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())],
                ["lang", "score"],
            )
        del scorer
        release_memory()

    return run(text)


def identify(
    docs: DataFrame,
    training: Column,
    model: bytes,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """All columns of docs, and two more for language and score; learns only from rows where `training` holds."""
    learned = fit(
        docs.filter(training).select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")),
        model,
        per_language,
    )
    (judged,) = unused(docs, "judged")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    both = [F.col(judged)[part].alias(name) for part, name in zip(("lang", "score"), names)]
    return docs.withColumn(judged, predict(F.col(f"`{text}`"), learned)).select(*columns, *both)
