"""Pieces against the library, language identification and the suffix tree against brute force."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wardlake.llm import langid, pieces, suffix_lm
from wardlake.llm.common import held_out
from wardlake.llm.flat import IntTable


@pytest.fixture(scope="module")
def library(piece_model):
    return sentencepiece.SentencePieceProcessor(model_proto=piece_model)


def odd_texts():
    random.seed(1)
    letters = " ab\n\tcé漢x  ▁<s>0x41 \U0001f600eeeeoootttthhhiiinnn aaaa=-\x00"
    some = ["", None, " ", "  a  ", "a" * 3000, " " * 3000, "x " * 40, "ab" * 700, "=-" * 400, "<s></s><unk><0x41>", "▁▁ ▁"]
    some += ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    return some + ["".join(random.choice("aeioustn ▁") for _ in range(random.randint(0, 400))) for _ in range(300)]


def test_ids_equal_the_library(piece_model, library):
    texts = odd_texts()
    table = pieces.load_pieces(piece_model)
    expected = library.encode([t or "" for t in texts])
    assert pieces.encode_texts(texts, table).to_pylist() == expected
    assert [pieces.decode_ids(ids, table) for ids in expected] == [library.decode(ids) for ids in expected]


def test_queue_and_rounds_agree(piece_model, monkeypatch):
    texts = odd_texts()
    table = pieces.load_pieces(piece_model)
    rounds = pieces.encode_texts(texts, table)
    monkeypatch.setattr(pieces, "LONG", 2)
    assert pieces.encode_texts(texts, table) == rounds


def test_any_ids_decode_like_the_library(piece_model, library):
    random.seed(4)
    table = pieces.load_pieces(piece_model)
    for _ in range(1500):
        ids = [random.randrange(32000) if random.random() < 0.5 else random.randrange(262) for _ in range(9)]
        assert pieces.decode_ids(ids, table) == library.decode(ids)
    assert pieces.decode_ids(None, table) == pieces.decode_ids([], table) == ""


def test_columns_round_trip(spark, documents, piece_model):
    docs = documents([(1, None), (2, ""), (3, "a  b\n c"), (3, "a  b\n c"), (None, "é\U0001f600")])
    rows = docs.withColumn("ids", pieces.encode(F.col("text"), piece_model)).withColumn(
        "back", pieces.decode(F.col("ids"), piece_model)
    )
    assert all(r.back == (r.text or "") for r in rows.collect())
    assert documents([]).select(pieces.encode(F.col("text"), piece_model)).count() == 0
    checked = docs.withColumn("both", pieces.encode_checked(F.col("text"), piece_model))
    own = checked.select("text", pieces.encode(F.col("text"), piece_model).alias("ids"), "both.*").toDF("text", "ids", "ids2", "same")
    assert all(r.ids == r.ids2 and r.same == (None if r.text is None else True) for r in own.collect())


def test_table_finds_exactly_its_keys():
    random.seed(0)
    keys = np.array(random.sample(range(1 << 40), 5000), np.int64)
    table = IntTable(keys)
    assert (table.find(keys) == np.arange(5000)).all()
    assert (table.find(keys + (1 << 41)) == -1).all()
    assert (IntTable(np.zeros(0, np.int64)).find(keys) == -1).all()


# language identification


def brute_word(word, vocabulary, weight, languages):
    total = np.zeros((len(word) + 2, languages))
    total[0] = 1
    marked = langid.MARK + word
    for stop in range(1, len(marked) + 1):
        for start in range(stop):
            if marked[start:stop] in vocabulary:
                total[stop] += total[start] * weight[vocabulary[marked[start:stop]]]
        if marked[stop - 1] not in vocabulary:
            total[stop] += total[stop - 1] * langid.UNKNOWN
    return np.log(total[len(marked)])


def test_forward_sums_all_segmentations():
    names = ("a", "ab", "aba", "b", "ba", "▁", "▁a", "▁b")
    weight = langid.with_unknown(np.random.default_rng(0).random((len(names), 3)))
    words = ["".join(p) for n in range(1, 6) for p in itertools.product("abq", repeat=n)]
    got = langid.word_scores(words, langid.trie_of(names), weight)
    vocabulary = {n: i for i, n in enumerate(names)}
    assert np.allclose(got, [brute_word(w, vocabulary, weight, 3) for w in words])


def brute_log_word(word, vocabulary, weight, languages):
    marked = langid.MARK + word
    total = np.full((len(marked) + 1, languages), -np.inf)
    total[0] = 0
    for stop in range(1, len(marked) + 1):
        for start in range(max(0, stop - 12), stop):
            if marked[start:stop] in vocabulary:
                total[stop] = np.logaddexp(total[stop], total[start] + np.log(weight[vocabulary[marked[start:stop]]]))
        if marked[stop - 1] not in vocabulary:
            total[stop] = np.logaddexp(total[stop], total[stop - 1] + np.log(langid.UNKNOWN))
    return total[len(marked)]


def test_long_words_are_summed_as_a_whole():
    """Words over any bound, pieces of any length, and letters without a piece beside known ones."""
    random.seed(6)
    names = ("a", "ab", "abababababab", "b", "ba", "▁", "▁a", "▁b")
    weight = langid.with_unknown(np.random.default_rng(1).random((len(names), 3)) / 10)
    vocabulary = {n: i for i, n in enumerate(names)}
    words = ["".join(random.choice("abq") for _ in range(n)) for n in (1, 29, 30, 31, 32, 64, 65, 200, 500)]
    words += ["q" * 40 + "a", "q" * 40 + "b", "ab" * 100]
    got = langid.word_scores(words, langid.trie_of(names), weight)
    assert np.allclose(got, [brute_log_word(w, vocabulary, weight, 3) for w in words])
    assert not np.allclose(got[-3], got[-2])  # what is known beside forty unknown letters still counts


def test_words_are_letters_and_marks():
    assert langid.words_of("½ ² Ⅷ ٣ 12_3 …") == []
    assert langid.words_of("नमस्ते दुनिया") == ["नमस्ते", "दुनिया"]
    assert langid.words_of("It's ÉCOLE-x2y\u0301") == ["it", "s", "école", "x", "y\u0301"]
    assert langid.words_of("\u0301\u0302") == []


def test_numbers_alone_are_no_language(spark, documents, piece_model):
    rows = [(1, "the house"), (2, "½ ²"), (3, "Ⅷ 12"), (4, "\u0301"), (5, "x" * 20_000)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(rows, lang="en"), F.lit(True), piece_model).collect()}
    assert [got[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert got[1][0] == got[5][0] == "en"


def test_training_choice_is_the_smallest_hashes(spark):
    docs = spark.range(3000).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise("rare").alias("lang"))
    docs = docs.union(docs.limit(50)).union(spark.createDataFrame([(None, "hot"), (5000, None)], "id bigint, lang string"))
    got = sorted(tuple(r) for r in langid.training_ids(docs, 40).collect())
    hashes = docs.filter("id is not null and lang is not null").distinct().withColumn("h", F.xxhash64("id")).collect()
    expected = [sorted((r.h, r.id) for r in hashes if r.lang == g)[:40] for g in ("hot", "rare")]
    assert got == sorted((i, g) for g, own in zip(("hot", "rare"), expected) for _, i in own)


def test_expected_uses_add_up():
    names = ("a", "ab", "b", "▁", "▁a")
    weight = langid.with_unknown(np.full((len(names), 1), 0.2))
    uses = langid.expected_uses(["ab"], np.array([[1.0]]), langid.trie_of(names), weight)[:, 0]
    # ▁|a|b, ▁|ab and ▁a|b, with probabilities 0.008, 0.04 and 0.04
    share = np.array([0.008, 0.04, 0.04]) / 0.088
    expected = {"a": share[0], "ab": share[1], "b": share[0] + share[2], "▁": share[0] + share[1], "▁a": share[2]}
    assert np.allclose(uses, [expected[n] for n in names])


def test_held_out_accuracy(spark, sf_dir, piece_model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out(F.col("doc_id"), 4, 2)
    judged = langid.identify(docs, ~out, piece_model).filter(out)
    facts = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert facts[0] >= 0.97 and 0 <= facts[1] <= facts[2] <= 1


def test_language_of_odd_rows(spark, documents, piece_model):
    rows = [(1, None), (2, ""), (3, "123 \n ###"), (4, "x" * 5000), (5, "some words"), (5, "some words"), (None, "漢字")]
    got = langid.identify(documents(rows, lang="en"), F.lit(True), piece_model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "und", 2: "und", 3: "und", 4: "en", 5: "en", None: "en"}
    unlearned = langid.identify(documents(rows), F.lit(True), piece_model).collect()
    assert {r.lang_pred for r in unlearned} == {"und"} and len(unlearned) == len(rows)


# suffix tree


def brute_scores(docs, parts=5, part=1):
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in docs}
    out = {i: zlib.crc32(str(i).encode()) % parts == part for i in tokens}
    counts = collections.Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    total = sum(counts.values())
    mass = total + 0.5 * (len(counts) + 1)
    return {
        i: (out[i], len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 0.5) / mass) for w in ws))
        for i, ws in tokens.items()
    }


def markov_docs(n=160, words=120):
    random.seed(6)
    after = {w: random.sample(range(40), 3) for w in range(40)}
    docs = []
    for i in range(n):
        w, text = random.randrange(40), []
        for _ in range(words):
            text.append(f"W{w}")
            w = random.choice(after[w]) if random.random() < 0.9 else random.randrange(40)
        docs.append((i, " ".join(text) + f" rare{i}"))
    return docs


def test_base_scores_equal_brute_force_and_the_tree_learns(spark, documents):
    docs = markov_docs() + [(900, None), (901, ""), (902, " \n\t"), (903, "unseen " * 3), (904, "É é É")]
    got = suffix_lm.score(documents(docs), held_out(F.col("doc_id"), 5, 1)).collect()
    expected = brute_scores(docs)
    for r in got:
        out, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got if r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_next_symbol_probabilities_sum_to_one(spark, monkeypatch, documents):
    trees = []
    finish = suffix_lm.finish
    monkeypatch.setattr(suffix_lm, "finish", lambda *a: trees.append(finish(*a)) or trees[0])
    suffix_lm.score(documents(markov_docs(60)), F.lit(False)).count()
    tree = trees[0]
    assert tree.kept.any()
    every = np.arange(tree.symbols)
    for state in [-1, *np.flatnonzero(tree.kept)[:40].tolist()]:
        assert (10 ** tree.log10(np.full(len(every), state), every)).sum() == pytest.approx(1, abs=1e-9)


def test_suffix_model_without_training_or_rows(spark, documents):
    rows = suffix_lm.score(documents([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}
    assert suffix_lm.score(documents([]), F.lit(False)).count() == 0
    same = suffix_lm.score(documents([(1, "a b"), (1, "a b"), (None, "a")]), F.lit(False)).collect()
    assert len(same) == 3 and len({r.score for r in same if r.doc_id == 1}) == 1
