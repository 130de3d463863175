"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts become flat numpy arrays of symbols, cut into words where no piece can reach across. In every
round each word finds the minimum rank among its neighbouring pairs, and its leftmost pairs of that
rank merge at once, for all words of a chunk together; words without a mergeable pair are finished
and leave the arrays. Equal words of a chunk are encoded once.

The reference order merges one pair at a time: best rank first, leftmost among equals. Merging all
leftmost pairs of a word at once gives the same result unless a merge creates a neighbour pair of the
same or a better rank; such a word merges only its leftmost pair in that round. Words of more than
`LONG` symbols go through a priority queue in that same order, because their rounds could be as many
as their symbols.

Defined cases: null texts are empty and have no ids; null id lists decode to the empty text. Characters
without a piece become byte pieces. All other columns stay as they are.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.flat import IntTable, chunks, mixed, multipliers, release_memory

SPACE = "▁"
NO_RANK = np.iinfo(np.int32).max
CODES = 0x110000
LONG = 256


@dataclass
class Pieces:
    """Vocabulary and merge table; a symbol is a piece id or, behind all ids, a code point."""

    size: int
    char_symbol: np.ndarray  # code point -> symbol
    pairs: IntTable  # of left * (size + CODES) + right
    pair_rank: np.ndarray  # by place in `pairs`; the last entry serves pairs that are no piece
    pair_symbol: np.ndarray
    byte_id: int  # id of the piece of byte 0; the other bytes follow
    surface: list[bytes]  # what each id decodes to, before the leading blank is dropped
    opens: np.ndarray  # whether a piece begins with the space symbol
    silent: np.ndarray  # control pieces
    splits: bool  # whether texts fall apart in front of space symbols

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where no piece results."""
        at = self.pairs.find(left * np.int64(self.size + CODES) + right)
        return self.pair_rank[at], self.pair_symbol[at]


@lru_cache(maxsize=4)
def load_pieces(model: bytes) -> Pieces:
    """Read vocabulary, scores and kinds of a BPE model with byte fallback."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(processor.get_piece_size())
    plain = {
        processor.id_to_piece(i): i
        for i in ids
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))
    }
    first_byte = next((i for i in ids if processor.is_byte(i)), None)
    if first_byte is None:
        raise ValueError("the model has no byte pieces")
    char_symbol = np.arange(CODES, dtype=np.int64) + len(ids)
    for piece, i in plain.items():
        if len(piece) == 1:
            char_symbol[ord(piece)] = i

    def symbol(part: str) -> int | None:
        return int(char_symbol[ord(part)]) if len(part) == 1 else plain.get(part)

    scores = sorted({processor.get_score(i) for i in plain.values()}, reverse=True)
    rank_of = {score: rank for rank, score in enumerate(scores)}
    rows = []
    for piece, i in plain.items():
        for cut in range(1, len(piece)):
            left, right = symbol(piece[:cut]), symbol(piece[cut:])
            if left is not None and right is not None:
                rows.append((left * (len(ids) + CODES) + right, rank_of[processor.get_score(i)], i))
    table = np.array(rows, dtype=np.int64).reshape(-1, 3)
    names = [processor.id_to_piece(i) for i in ids]
    surface = []
    for i, name in enumerate(names):
        if processor.is_byte(i):
            surface.append(bytes([i - first_byte]))
        elif processor.is_control(i):
            surface.append(b"")
        elif processor.is_unknown(i):
            surface.append(" ⁇ ".encode())
        else:
            surface.append(name.replace(SPACE, " ").encode())
    return Pieces(
        size=len(ids),
        char_symbol=char_symbol,
        pairs=IntTable(table[:, 0]),
        pair_rank=np.append(table[:, 1], NO_RANK).astype(np.int32),
        pair_symbol=np.append(table[:, 2], -1),
        byte_id=first_byte,
        surface=surface,
        opens=np.array([n.startswith(SPACE) for n in names]),
        silent=np.array([processor.is_control(i) for i in ids]),
        splits=not any(SPACE in n.lstrip(SPACE) for n in plain),
    )


def merge_queue(symbols: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Merge one word pair by pair, best rank first and leftmost among equals."""
    live = symbols.tolist()
    after = [*range(1, len(live)), -1]
    before = list(range(-1, len(live) - 1))
    queue = []

    def offer(left: int, right: int) -> None:
        rank, whole = pieces.merges(np.array([live[left]]), np.array([live[right]]))
        if rank[0] < NO_RANK:
            heapq.heappush(queue, (int(rank[0]), left, live[left], live[right], int(whole[0])))

    rank, whole = pieces.merges(symbols[:-1], symbols[1:])
    for i in np.flatnonzero(rank < NO_RANK).tolist():
        queue.append((int(rank[i]), i, live[i], live[i + 1], int(whole[i])))
    heapq.heapify(queue)
    while queue:
        _, left, a, b, whole = heapq.heappop(queue)
        right = after[left]
        if live[left] != a or right < 0 or live[right] != b:
            continue  # one side has merged meanwhile
        live[left], live[right] = whole, -1
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    return np.array([s for s in live if s >= 0], np.int64)


def merge_rounds(symbols: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of all words, word by word, and how many each word has.

    `symbols` holds the words one after the other.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = []
    n_words = len(sizes)
    word = np.arange(n_words)
    while len(word):
        begin = np.cumsum(sizes) - sizes
        rank = np.full(len(symbols), NO_RANK, np.int32)
        whole = symbols[:0]
        if len(symbols) > 1:
            rank[:-1], whole = pieces.merges(symbols[:-1], symbols[1:])
        rank[begin + sizes - 1] = NO_RANK
        best = np.minimum.reduceat(rank, begin)
        active = best < NO_RANK
        at_word = np.repeat(np.arange(len(sizes)), sizes)
        stays = active[at_word]
        if not active.all():
            done.append((word[at_word[~stays]], symbols[~stays]))
        places = np.flatnonzero(stays & (rank == best[at_word]))
        if not len(places):
            break
        # of overlapping pairs in a row, every second one counted from the left
        heads = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        run = np.repeat(places[heads], np.diff(np.append(heads, len(places))))
        places = places[(places - run) % 2 == 0]
        several = np.bincount(at_word[places], minlength=len(sizes)) > 1
        if several.any():
            places = safe_places(places, symbols, whole, at_word, best, several, pieces)
        symbols = symbols.copy()
        symbols[places] = whole[places]
        stays[places + 1] = False
        sizes = (sizes - np.bincount(at_word[places], minlength=len(sizes)))[active]
        symbols, word = symbols[stays], word[active]
    if not done:
        return symbols[:0], np.zeros(n_words, np.int64)
    words = np.concatenate([d[0] for d in done])
    order = np.argsort(words, kind="stable")
    return np.concatenate([d[1] for d in done])[order], np.bincount(words, minlength=n_words)


def safe_places(places, symbols, whole, at_word, best, several, pieces: Pieces) -> np.ndarray:
    """Only the first place of words where a merge would bring up a pair of the same or a better rank."""
    merged = symbols.copy()
    merged[places] = whole[places]
    gone = np.zeros(len(symbols), bool)
    gone[places + 1] = True
    own = at_word[places]
    # the left neighbour has merged by then, the right one has not
    left = np.maximum(places - 1, 0)
    left = np.where(gone[left], np.maximum(left - 1, 0), left)
    has_left = (places > 0) & (at_word[left] == own)
    right = np.minimum(places + 2, len(symbols) - 1)
    has_right = (places + 2 < len(symbols)) & (at_word[right] == own)
    new = merged[places]
    limit = best[own]
    bad = has_left & (pieces.merges(merged[left], new)[0] <= limit)
    bad |= has_right & (pieces.merges(new, symbols[right])[0] <= limit)
    unsafe = np.zeros(len(several), bool)
    unsafe[own[bad]] = True
    unsafe &= several
    first = np.append(True, own[1:] != own[:-1])
    return places[first | ~unsafe[own]]


def with_bytes(symbols: np.ndarray, counts: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of final symbols; code points without a piece become their UTF-8 bytes."""
    unknown = np.flatnonzero(symbols >= pieces.size)
    if not len(unknown):
        return symbols, counts
    spelled = [chr(s - pieces.size).encode() for s in symbols[unknown].tolist()]
    extra = np.fromiter(map(len, spelled), np.int64, len(spelled)) - 1
    word = np.repeat(np.arange(len(counts)), counts)
    grown = counts + np.bincount(word[unknown], weights=extra, minlength=len(counts)).astype(np.int64)
    widths = np.ones(len(symbols), np.int64)
    widths[unknown] += extra
    ids = np.repeat(symbols, widths)
    begin = (np.cumsum(widths) - widths)[unknown]
    for start, spelling in zip(begin.tolist(), spelled):
        ids[start : start + len(spelling)] = np.frombuffer(spelling, np.uint8) + np.int64(pieces.byte_id)
    return ids, grown


def encode_words(symbols: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, word by word, and how many each word has."""
    long = sizes > LONG
    if not long.any():
        return with_bytes(*merge_rounds(symbols, sizes, pieces), pieces)
    begin = np.cumsum(sizes) - sizes
    queued = [merge_queue(symbols[begin[w] : begin[w] + sizes[w]], pieces) for w in np.flatnonzero(long).tolist()]
    rounds, n_rounds = merge_rounds(symbols[~np.repeat(long, sizes)], sizes[~long], pieces)
    counts = np.zeros(len(sizes), np.int64)
    counts[long], counts[~long] = [len(q) for q in queued], n_rounds
    final = np.empty(counts.sum(), np.int64)
    from_queue = np.repeat(long, counts)
    final[from_queue], final[~from_queue] = np.concatenate(queued), rounds
    return with_bytes(final, counts, pieces)


def encode_chunk(texts: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each text has."""
    marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    counts = np.zeros(len(texts), np.int64)
    if not lengths.sum():
        return np.empty(0, np.int32), counts
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
    starts_text = np.zeros(len(chars), bool)
    starts_text[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    if pieces.splits:
        space = chars == ord(SPACE)
        begins = space & ~np.append(False, space[:-1]) | starts_text
    else:
        begins = starts_text
    begin = np.flatnonzero(begins)
    size = np.diff(np.append(begin, len(chars)))
    place = np.arange(len(chars)) - np.repeat(begin, size)
    code = mixed(chars.astype(np.uint64) + np.uint64(1)) * multipliers(int(size.max()))[place]
    name = mixed(np.add.reduceat(code, begin) + size.astype(np.uint64))
    _, sample, kind = np.unique(name, return_index=True, return_inverse=True)
    # the distinct words, one after the other
    sizes = size[sample]
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols = pieces.char_symbol[chars[np.repeat(begin[sample], sizes) + inner]]
    table, n_ids = encode_words(symbols, sizes, pieces)
    table = table.astype(np.int32)
    # every word of the texts takes the ids of its kind
    of_word = n_ids[kind]
    total = np.cumsum(of_word)
    source = np.repeat((np.cumsum(n_ids) - n_ids)[kind] - (total - of_word), of_word) + np.arange(total[-1])
    text_of_word = np.searchsorted(np.cumsum(lengths), begin, side="right")
    counts += np.bincount(text_of_word, weights=of_word, minlength=len(texts)).astype(np.int64)
    return table[source], counts


def encode_texts(texts: pa.Array | list[str | None], pieces: Pieces) -> pa.Array:
    """One list of ids per text."""
    parts = [encode_chunk(part, pieces) for _, part in chunks(texts)]
    if not parts:
        return pa.array([], pa.list_(pa.int32()))
    ids = np.concatenate([p[0] for p in parts])
    ends = np.cumsum(np.concatenate([p[1] for p in parts]))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode_ids(ids: list[int] | None, pieces: Pieces) -> str:
    """Text of a list of ids; bytes that are no UTF-8 become one replacement character each."""
    if not ids:
        return ""
    codecs.register_error("wardlake_each_byte", _each_byte)
    text = b"".join(map(pieces.surface.__getitem__, ids)).decode("utf-8", "wardlake_each_byte")
    loud = next((i for i in ids if not pieces.silent[i]), None)
    return text[1:] if loud is not None and pieces.opens[loud] else text


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, read on the driver and sent along; tasks need no file of their own."""
    with open(path, "rb") as file:
        return file.read()


def encode(text: Column, model: bytes) -> Column:
    """Ids of a text column as array<int>, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = load_pieces(model)
        for batch in batches:
            yield encode_texts(batch, pieces)

    return run(text)


def decode(ids: Column, model: bytes) -> Column:
    """Text of a column of ids."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = load_pieces(model)
        for batch in batches:
            values, bounds = batch.values.to_numpy(), batch.offsets.to_pylist()
            lists = (values[a:b].tolist() for a, b in pairwise(bounds))
            yield pa.array([decode_ids(x, pieces) for x in lists], pa.string())

    return run(ids)


def encode_checked(text: Column, model: bytes) -> Column:
    """struct<ids, round_trip> of a text column: the ids, and whether decoding gives the text back (null for null).

    One worker does both, so a job has half the workers that encoding and decoding by themselves have.
    """

    @F.arrow_udf("struct<ids:array<int>,round_trip:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = load_pieces(model)
        for batch in batches:
            ids = encode_texts(batch, pieces)
            values, bounds = ids.values.to_numpy(), ids.offsets.to_pylist()
            same = [
                None if own is None else decode_ids(values[a:b].tolist(), pieces) == own
                for own, (a, b) in zip((t.as_py() for t in batch), pairwise(bounds))
            ]
            yield pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], ["ids", "round_trip"])
        release_memory()

    return run(text)
