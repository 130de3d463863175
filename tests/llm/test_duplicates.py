"""Near duplicates, repeated passages, components and the pipeline against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.llm import neardup, paragraphs
from wardlake.llm.flat import split_words
from wardlake.llm.graph import components, joined_components


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_components(ids, linked):
    label = {i: i for i in ids}
    for a, b in linked:
        low, high = sorted((label[a], label[b]))
        label = {i: low if x == high else x for i, x in label.items()}
    return label


def changed(text, n):
    words = text.split()
    for at in random.sample(range(len(words)), n):
        words[at] = f"new{random.randrange(10**9)}"
    return " ".join(words)


def prose(n):
    return " ".join(f"w{random.randrange(400)}" for _ in range(n))


def test_components_of_chains_stars_and_pairs(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    random.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: (0 if i < 100 else 100 if i < 200 else 200) for i in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("nodes", [0, 1000])
def test_components_alike_broadcast_or_shuffled(spark, nodes):
    links = [(i, i + 1) for i in range(30)] + [(50, 40), (60, 50), (70, 71)]
    random.Random(5).shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), nodes).collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 50: 40, 60: 40, 70: 70, 71: 70}


def test_more_links_join_known_components(spark):
    """The links of the second comparison go by the components that they join, not by all links once more."""
    draw = random.Random(11)
    first = [(draw.randrange(300), draw.randrange(300)) for _ in range(120)]
    for more in ([], [(draw.randrange(400), draw.randrange(400)) for _ in range(60)]):
        frames = [spark.createDataFrame(part, "a long, b long") for part in (first, more)]
        both = components(frames[0].union(frames[1])).collect()
        got = {r.node: r.component for r in joined_components(components(frames[0]), frames[1]).collect()}
        named = {n for link in more for n in link} - {r.node for r in both}
        assert got == {r.node: r.component for r in both} | {n: n for n in named}


def test_near_duplicates_equal_brute_force(spark, documents):
    random.seed(7)
    base, hub = prose(120), prose(150)
    docs = [(i, prose(random.randint(1, 80))) for i in range(40)]
    docs += [(100 + i, changed(base, i)) for i in range(12)]  # from near to far
    docs += [(200 + i, changed(hub, random.randint(0, 14))) for i in range(60)] + [(300, hub), (301, hub.upper())]
    docs += [(400, "one"), (401, "ONE"), (402, "one two"), (403, None), (404, ""), (405, " \n"), (406, "x" * 100_000)]
    random.shuffle(docs)
    got = {r.doc_id: r for r in neardup.near_duplicates(documents(docs), words=4).collect()}
    sets = {i: shingles(t, 4) for i, t in docs}
    linked = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = brute_components(sets, linked)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), label[i], label[i] == i) for i, s in sets.items()
    }


def test_sketch_never_rules_out_a_similar_pair():
    random.seed(3)
    for n in (5, 60, 900):
        text = prose(n)
        for k in range(0, n, max(1, n // 9)):
            x, y = neardup.shingle_sets([text, changed(text, k)], 4)
            bits = [b"".join(w.to_bytes(8, "little", signed=True) for w in neardup.sketch(s).tolist()) for s in (x, y)]
            differ = (int.from_bytes(bits[0], "little") ^ int.from_bytes(bits[1], "little")).bit_count()
            assert differ <= len(set(x.tolist()) ^ set(y.tolist()))


def test_one_row_of_each_group_stays(spark, documents):
    text = "a b c d e f g"
    docs = documents([(3, text), (2, text), (2, text), (None, text), (5, "other words entirely here"), (6, None), (6, None), (7, "")])
    kept = neardup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "5", "6", "7"]
    assert neardup.drop_duplicates(documents([])).count() == 0


# passages


def flagged(frame):
    return {(r.doc_id, r.start, r.stop) for r in frame.collect()}


def sentences(n):
    return " ".join(" ".join(f"s{random.randrange(10**6)}" for _ in range(random.randint(4, 12))).capitalize() + "." for _ in range(n))


def test_every_long_passage_is_found_and_clean_texts_are_left_alone(spark, documents):
    random.seed(11)
    passages = [sentences(9) for _ in range(15)]
    docs, holders = [], set()
    for i in range(80):
        words = sentences(20).split()
        if i < 45:
            at = random.randrange(len(words))
            words[at:at] = passages[i % 15].split()
            holders.add(i)
        docs.append((i, " ".join(words)))
    docs += [(90, None), (91, ""), (92, "Short. Text."), (93, "y" * 50_000)]
    found = paragraphs.repeated_paragraphs(documents(docs)).collect()
    assert {r.doc_id for r in found} == holders
    text = dict(docs)
    for r in found:  # what is marked lies in a passage, but for a word at its edges
        body = text[r.doc_id][r.start : r.stop]
        assert any(" ".join(body.split()[k:-k]) in passage for passage in passages for k in (1, 2, 12) if len(body.split()) > 2 * k)
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    for rows in by_component.values():  # overlapping paragraphs of one text may be similar; they stay together
        assert len({r.doc_id for r in rows if not r.removed}) == 1 and len(rows) == rows[0].copies
        assert all(r.removed for r in rows if r.doc_id != min(x.doc_id for x in rows))


def test_near_paragraphs_join_and_repeats_inside_a_text_count(spark, documents):
    random.seed(13)
    one = " ".join(f"q{i}" for i in range(38)) + "."
    near = one.replace("q37", "other")
    docs = documents([(1, one), (2, near), (3, sentences(8)), (4, f"{sentences(2)} {one} {sentences(6)} {one}")])
    rows = paragraphs.repeated_paragraphs(docs).collect()
    assert {r.doc_id for r in rows} >= {1, 2, 4} and 3 not in {r.doc_id for r in rows}
    assert len({r.component for r in rows if r.doc_id in (1, 2)}) == 1
    assert paragraphs.repeated_paragraphs(documents([])).count() == 0


def test_rows_that_repeat_are_one_document(spark, documents):
    random.seed(17)
    text = sentences(12)
    assert paragraphs.repeated_paragraphs(documents([(1, text), (1, text)])).count() == 0
    rows = paragraphs.repeated_paragraphs(documents([(1, text), (None, text)])).collect()
    assert {r.doc_id for r in rows} == {1, None}


def test_copies_have_the_same_paragraphs_whatever_stands_beside_them(spark, documents):
    random.seed(23)
    ones = [" ".join(f"t{random.randrange(10**6)}" for _ in range(30)) for _ in range(40)]
    rows = [(100 * i + k, text) for i, text in enumerate(ones) for k in range(3)]
    rows += [(10_000 + i, sentences(5)) for i in range(60)] + [(20_000, "z" * 300_000)]
    random.shuffle(rows)
    found = {r.doc_id for r in paragraphs.repeated_paragraphs(documents(rows)).collect()}
    assert found == {100 * i + k for i in range(40) for k in range(3)}

    def chosen(texts):
        flat = split_words(texts)
        first, behind, *_ = paragraphs.bounds(flat, 20)
        text = np.searchsorted(flat.first, first, side="right") - 1
        return [[(int(a - flat.first[t]), int(b - flat.first[t])) for a, b, at in zip(first, behind, text) if at == t] for t in range(len(texts))]

    texts = [text for _, text in rows[:80]] + [sentences(5) + f" E{i} f{i}." for i in range(40)]
    assert chosen(texts) == [chosen([text])[0] for text in texts]


@pytest.mark.parametrize("ended", [True, False])
def test_passages_of_51_to_70_words_at_any_place_are_found(spark, documents, ended):
    random.seed(29)
    docs, holders = [], set()
    for i in range(60):
        source = sentences(30).split()
        at = random.randrange(len(source) - 70)
        passage = source[at : at + random.randint(51, 70)]
        for k in range(3):
            host = sentences(12).split()
            place = random.randrange(len(host))
            text = " ".join(host[:place] + passage + host[place:])
            docs.append((10 * i + k, text if ended else text.replace(".", "")))
            holders.add(10 * i + k)
    docs += [(1000 + i, sentences(20).replace("." if not ended else "", "")) for i in range(30)]
    rows = paragraphs.repeated_paragraphs(documents(docs)).collect()
    assert {r.doc_id for r in rows} == holders


def test_every_word_of_a_text_lies_in_a_paragraph():
    for text in ("x " * 500, " ".join(f"u{i}" for i in range(331)), "Ab cd. " * 40 + "end"):
        flat = split_words([text])
        covered = np.zeros(len(flat.start), bool)
        for first, behind in zip(*paragraphs.bounds(flat, 20)[:2]):
            covered[first:behind] = True
        assert covered.all()


def test_all_paragraphs_are_posted_under_all_bands(spark, documents):
    random.seed(31)
    texts = [sentences(12) for _ in range(20)] + [sentences(14).replace(".", "") for _ in range(10)]
    digests = set()
    for text in texts:
        flat = split_words([text])
        first, behind = paragraphs.bounds(flat, 20)
        last = behind - paragraphs.SHINGLE + 1
        digests |= set(paragraphs.digests(paragraphs.runs(flat.hash, paragraphs.SHINGLE), first, last).tolist())
    posted = paragraphs.postings(documents(enumerate(texts)).select("text"), 20, paragraphs.BANDS, paragraphs.ROWS)
    keys = {}
    for key, of in posted.select("key", "class").collect():
        keys.setdefault(of, set()).add(key)
    assert set(keys) == digests and {len(k) for k in keys.values()} == {paragraphs.BANDS}


def test_similar_paragraphs_join_wherever_they_begin(spark, documents):
    """Against all pairs of paragraphs; rows may leave out edges that no other paragraph shares."""
    random.seed(37)
    docs = []
    for i in range(30):
        words = sentences(4).split()
        for k in range(3):
            body = list(words)
            for at in random.sample([0, 1, len(body) - 2, len(body) - 1], k):
                body[at] = body[at].replace("s", f"t{k}", 1).replace("S", f"T{k}", 1)
            docs.append((10 * i + k, f"{sentences(random.randint(2, 5))} {' '.join(body)} {sentences(random.randint(2, 5))}"))
    found = {}
    for r in paragraphs.repeated_paragraphs(documents(docs)).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.stop, r.component))

    def listed(text):
        flat = split_words([text])
        for first, behind in zip(*paragraphs.bounds(flat, 20)):
            start, stop = int(flat.start[first]), int(flat.stop[behind - 1])
            yield start, stop, shingles(text[start:stop], 5)

    def marked(doc, start, stop):
        return {c for a, b, c in found.get(doc, []) if start <= a and b <= stop and b - a >= 0.7 * (stop - start)}

    every = {i: list(listed(text)) for i, text in docs}
    pairs = unequal = missed = 0
    for i in every:
        for j in (j for j in every if i < j < i // 10 * 10 + 3):
            for a, b, x in every[i]:
                for c, d, y in every[j]:
                    if 10 * len(x & y) >= 8 * len(x | y):
                        pairs, unequal = pairs + 1, unequal + (x != y)
                        missed += not marked(i, a, b) & marked(j, c, d)
    assert unequal > 30 and missed <= 0.02 * pairs


def test_edges_that_no_other_paragraph_shares_are_not_marked():
    body = " ".join(f"v{i}" for i in range(22))
    good, (a_from, a_to, b_from, b_to) = paragraphs.compared([f"one two {body}", body, "x " * 30], [f"{body} end", body.upper(), "y " * 30], (8, 10))
    assert good.tolist() == [True, True, False]
    assert (a_from.tolist(), a_to.tolist()) == ([8, 0], [8 + len(body), len(body)])
    assert (b_from.tolist(), b_to.tolist()) == ([0, 0], [len(body), len(body)])


# pipeline


@pytest.fixture
def pipeline_dir(spark, documents, folder):
    random.seed(19)
    english = lambda n: " ".join(random.choice(["the", "house", "water", "green", "under", "with", "people"]) + random.choice(["", "s", "ing", "ly"]) for _ in range(n))
    item = english(14)
    base = english(80)
    rows = [(i, english(60)) for i in range(20)]
    rows += [(30, base), (31, base), (32, base + " end"), (40, f"{english(30)} {item} {english(30)}")]
    rows += [(50, english(20) + " password=abcdef12 " + english(20)), (60, "### 123"), (61, None), (62, "")]
    documents(rows, lang="en").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_stage_by_stage(spark, pipeline_dir, piece_model):
    import sentencepiece

    import corpus_pipeline

    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, pipeline_dir).collect()}
    assert set(rows) == {*range(20), 30, 50}
    for r in rows.values():
        assert r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.round_trip
        assert r.n_chars == len(r.text)
    assert "password" not in rows[50].text and "[SECRET]" in rows[50].text


def test_stages_keep_the_columns(spark, pipeline_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{pipeline_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, pipeline_dir).columns == docs.columns
    # columns named like those that the operators use inside or return are carried along as they are
    names = "score lang_pred judged _judged findings _findings blob _blob ids n_tokens round_trip id _id print _print".split()
    extra = docs.limit(40).withColumns({name: F.concat(F.lit(f"{name} "), "doc_id") for name in names})
    extra = spark.createDataFrame(extra.collect(), extra.schema)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, extra, pipeline_dir)
        assert kept.columns[: len(extra.columns)] == extra.columns
        rows = kept.collect()
        assert rows and all(r[name] == f"{name} {r.doc_id}" for r in rows for name in names)
    empty = docs.filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, pipeline_dir).count() == 0
