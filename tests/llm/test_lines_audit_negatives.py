"""Line dedup, filter audit and hard negatives against brute force."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.llm import filter_audit, lines, negatives
from wardlake.llm.cuckoo import Cuckoo, buckets_for
from wardlake.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"


def random_keys(n, seed):
    return np.random.default_rng(seed).integers(-(2**63), 2**63, n, dtype=np.int64)


# -- cuckoo filters


def test_cuckoo_filter_holds_all_keys_and_few_others():
    keys = random_keys(20_000, 1)
    table = Cuckoo(buckets_for(len(keys)))
    table.insert(keys[:7_000])
    table.insert(keys[7_000:])
    assert table.contains(keys).all()
    assert len(table) == len(keys)
    assert table.contains(random_keys(20_000, 2)).mean() < 0.005


def test_cuckoo_filter_gives_keys_up_and_survives_bytes():
    keys = random_keys(5_000, 3)
    table = Cuckoo(buckets_for(len(keys)))
    table.insert(keys)
    table = Cuckoo(table.buckets, table.tobytes())
    table.delete(keys[::2])
    assert table.contains(keys[1::2]).all()
    assert len(table) == 2_500
    assert table.contains(keys[::2]).mean() < 0.005
    table.delete(keys[1::2])
    assert len(table) == 0


def test_cuckoo_filter_grows_beyond_its_size_and_refuses_unknown_keys():
    keys = random_keys(2_000, 4)
    table = Cuckoo(64)  # 256 places a table
    table.insert(keys)
    table.insert(keys[:10])  # held twice
    assert len(table.slots) > 1 and len(table) == 2_010
    table.delete(keys)
    assert len(table) == 10 and table.contains(keys[:10]).all()
    with pytest.raises(KeyError):
        table.delete(random_keys(100, 5))
    empty = Cuckoo(8)
    empty.insert(keys[:0])
    empty.delete(keys[:0])
    assert not empty.contains(keys[:5]).any()


# -- lines


def key_of(line):
    key = line.strip(BLANKS)
    return "".join(c.lower() if c.isascii() else c for c in key)


def brute_lines(rows, min_docs=3):
    """rows: (id, text) -> sorted rows of id, n_lines, n_dropped, kept text."""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                held[key_of(line)].add(i)
    largest = {k: max(ids, key=lambda i: (i is not None, i)) for k, ids in held.items() if len(ids) >= min_docs}
    result = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [line for line in own if key_of(line) not in largest or largest[key_of(line)] == i]
        result.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(result, key=str)


def some_lines(n, seed):
    rng = random.Random(seed)
    common = [f"This line is number {k} of those that repeat" for k in range(40)]
    common += ["twenty code points äöü", "Ünï" * 7, "short", "", " " * 30, "x" * 19, "y" * 20]

    def line():
        text = rng.choice(common) if rng.random() < 0.7 else f"a line of its own, {rng.random()}"
        text = text.upper() if rng.random() < 0.2 else text
        return rng.choice(["", " ", "\t ", "\r"]) + text + rng.choice(["", "  ", "\r", "\x0b"])

    return [(i, "\n".join(line() for _ in range(rng.randint(1, 12)))) for i in range(n)]


def result_of(docs, index):
    return sorted((tuple(r) for r in lines.drop_repeated(docs, index).collect()), key=str)


def filter_state(index):
    """Fingerprints held by all filters, and whether every held key is found."""
    commits = index.commits()
    tables = {r.shard: Cuckoo(buckets_for(index.keys_per_shard), r.filter) for r in index._filters(commits).collect()}
    bits = commits[-1].bits
    found = [tables[r.hi % 2**64 >> (64 - bits) if bits else 0].contains(np.array([r.lo]))[0] for r in index._counts(commits).collect()]
    return sum(len(t) for t in tables.values()), len(found), all(found)


def test_lines_equal_brute_force(spark, documents, folder):
    rows = some_lines(60, 1)
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "z" * 300_000 + "\n" + rows[0][1]), (104, rows[3][1])]
    docs = documents(rows)
    index = lines.LineIndex(spark, folder)
    index.insert(docs)
    assert result_of(docs, index) == brute_lines(rows)
    assert any(r[2] for r in brute_lines(rows))


def test_lines_with_repeated_null_and_text_ids(spark, folder):
    rows = some_lines(25, 2)
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, rows[2][1]), (3, rows[3][1]), (4, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    index = lines.LineIndex(spark, folder)
    index.insert(docs)
    assert result_of(docs, index) == brute_lines(rows)
    named = [(f"doc {i}", text) for i, text in some_lines(25, 3)]
    docs = spark.createDataFrame(named, "doc_id string, text string")
    index = lines.LineIndex(spark, scratch_path(spark, "lines"))
    index.insert(docs)
    assert result_of(docs, index) == brute_lines(named)


def test_lines_of_an_empty_table_and_an_empty_index(spark, documents, folder):
    index = lines.LineIndex(spark, folder)
    docs = documents(some_lines(3, 4))
    assert result_of(docs, index) == [(i, len(t.split("\n")), 0, t) for i, t in some_lines(3, 4)]
    index.delete(docs)
    index.compact()
    index.insert(docs.limit(0))
    assert result_of(docs.limit(0), index) == []
    index.insert(docs)
    assert result_of(docs, index) == brute_lines(some_lines(3, 4))


def test_lines_in_steps_equal_lines_at_once(spark, documents, folder):
    """Insertions, deletions, a second insertion and shards that split; the state is that of a fresh index."""
    rows = some_lines(90, 5)
    index = lines.LineIndex(spark, folder, keys_per_shard=40)
    for start in (0, 30, 60):
        index.insert(documents(rows[start : start + 30]))
    index.insert(documents(rows[10:50]))  # held already
    assert index.commits()[-1].bits > 0
    assert result_of(documents(rows), index) == brute_lines(rows)
    gone = {i for i, _ in rows if i % 3 == 0 or i > 80}
    index.delete(documents([r for r in rows if r[0] in gone]))
    left = [r for r in rows if r[0] not in gone]
    assert result_of(documents(left), index) == brute_lines(left)
    fresh = lines.LineIndex(spark, scratch_path(spark, "lines"), keys_per_shard=40)
    fresh.insert(documents(left))
    ours, theirs = (sorted(tuple(r) for r in i._counts(i.commits()).collect()) for i in (index, fresh))
    assert ours == theirs
    held, keys, found = filter_state(index)
    assert held == keys == len(theirs) and found
    back = [r for r in rows if r[0] in gone and r[0] % 2]
    index.insert(documents(back))
    assert result_of(documents(left + back), index) == brute_lines(left + back)
    index.compact()
    assert len(index.commits()) == 1
    assert result_of(documents(left + back), index) == brute_lines(left + back)
    index.delete(documents(left + back))
    assert filter_state(index) == (0, 0, True)


def test_an_unfinished_insertion_does_not_count(spark, documents, folder, monkeypatch):
    rows = some_lines(40, 6)
    index = lines.LineIndex(spark, folder)
    index.insert(documents(rows[:20]))

    def dies(*args):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as patch:
        patch.setattr(index, "_commit", dies)
        with pytest.raises(RuntimeError):
            index.insert(documents(rows[20:]))
    assert result_of(documents(rows[:20]), index) == brute_lines(rows[:20])
    index.insert(documents(rows[20:]))
    assert result_of(documents(rows), index) == brute_lines(rows)


def test_known_keys_come_from_the_filters(spark, documents, folder):
    index = lines.LineIndex(spark, folder)
    docs = documents([(1, "a line that is held by the index"), (2, "another line that is not in it")])
    assert [r.known for r in index.known_keys(docs).collect()] == [False, False]
    index.insert(docs.filter("doc_id = 1"))
    assert {r.doc_id: r.known for r in index.known_keys(docs).collect()} == {1: True, 2: False}


# -- filter audit


def brute_audit(rows, labels):
    """rows: (id, text, source); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    judged = []
    for i, text, source in rows:
        text = text or ""
        words = text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
        words = [w for w in words.split(" ") if w]
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if i is not None and i > first[text]:
            fails.add("E")
        judged.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(gone)
                redundant = sum(f in j[1] for j in own) - len(gone) - sum(f in j[1] for j in left)
                alone = sum(j[1] == {f} for j in own)
                row = [len(left), len(gone), redundant, alone, sum(j[2] for j in gone), sum(j[3] for j in gone)]
                out[part, "".join(order), step] = row
        for key in out:
            if key[0] == part and len(out[key]) == 6:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def audit_rows():
    rng = random.Random(8)
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 49, 50, 51, 80])
        words = [f"w{rng.randrange(rng.choice([5, 1000]))}" for _ in range(n)]
        text = rng.choice([" ", "\n", "\x0b", "\xa0 "]).join(words)
        text += rng.choice(["", "", " #", " |"]) + rng.choice(["", "", " ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
        rows.append((i, text, rng.choice(["a", "a", "b", None, ""])))
    rows += [(1000 + i, rows[i % 40][1], rng.choice(["a", "c"])) for i in range(120)]
    rows += [(5, rows[5][1], "b"), (2000, None, "c"), (2001, "", "c"), (None, rows[7][1], "a"), (None, "only here", None)]
    rows += [(3000, "long words " * 40_000, "c")]
    rng.shuffle(rows)
    return rows


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 5 == 0)) for i, _, _ in rows if i is not None and i % 3]
    labels += [(1, 1, None), (1, None, 1), (None, 1, 1), (2, None, None), (99_999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    for clash in ("n", "mask", "part", "digest", "quality", "toxic", "good", "lowest", "held"):
        docs = docs.withColumn(clash, F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("source", F.lit("clash"))
    names = ["part", "filter_order", "step", *filter_audit.COUNTS]
    found = filter_audit.audit(docs, marks).select(*names).collect()
    assert {tuple(r)[:3]: list(r)[3:] for r in found} == brute_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs, marks).collect() == []
    one = spark.createDataFrame([(1, "x", "s")], docs.schema)
    found = filter_audit.audit(one, marks).collect()
    assert len(found) == 600 and sum(r.removed for r in found) == 120


def test_removal_steps_are_the_first_failing_place():
    orders = np.array(list(permutations(range(3))))
    steps = filter_audit.removal_steps(filter_audit.fail_matrix(3), filter_audit.places(orders))
    for mask in range(8):
        for k, order in enumerate(orders):
            expected = next((s for s, f in enumerate(order, 1) if mask >> f & 1), 4)
            assert steps[mask, k] == expected


# -- hard negatives


def brute_negatives(rows, every, most=(5, 10), band=(30, 90), scale=256):
    """rows: (id, label, vector), already one for each id."""

    def numbers(v):
        return [int(np.floor(scale * np.float64(x))) for x in v]

    held = {i: (label, numbers(v)) for i, label, v in rows}
    out = set()
    for a, (label, own) in held.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(own, v)) for i, (_, v) in held.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][0] == label][: most[0]]:
            fits = [
                i for i in order
                if held[i][0] != label and band[0] * score[p] <= 100 * score[i] <= band[1] * score[p]
            ]
            out |= {(a, p, rank, i, score[p], score[i]) for rank, i in enumerate(fits[: most[1]], 1)}
    return out


def some_vectors(n, dims, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    vectors = 0.6 * centres[label] + 0.4 * centres[(label + 1) % labels] + 0.5 * rng.normal(size=(n, dims))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(int(i), int(l), [float(x) for x in v.astype(np.float32)]) for i, (l, v) in enumerate(zip(label, vectors))]


def test_table_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for low, high in ((-300, 300), (0, 5), (-1, 1), (-(2**20), 2**20), (5, 6), (-3, -2)):
        anchors, candidates = rng.integers(low, high, (7, 24)), rng.integers(low, high, (50, 24))
        found = negatives.scores(anchors, negatives.bit_planes(candidates))
        assert (found == candidates @ anchors.T).all()
    wide = negatives.scores(np.ones((1, 32), np.int64), negatives.bit_planes(np.ones((3, 16), np.int64)))
    assert wide.tolist() == [[16]] * 3
    with pytest.raises(OverflowError):
        negatives.scores(np.full((1, 8), 2**40), negatives.bit_planes(np.full((2, 8), 2**30)))


def test_negatives_equal_brute_force(spark):
    rows = some_vectors(700, 20, 4, 2)
    rows[100] = (100, 9, rows[100][2])  # a label of its own: no positive
    rows[201] = (201, rows[200][1], rows[200][2])  # ties
    rows[202] = (202, rows[200][1], rows[200][2])
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(5)
    for clash in ("n", "slot", "ids", "positives", "rank", "count", "row"):
        frame = frame.withColumn(clash, F.lit("clash"))
    found = [tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 20 == 0).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_negatives(rows, 20)
    assert len({r[0] for r in found}) > 20


def test_negatives_with_many_labels_and_other_parameters(spark):
    rows = some_vectors(300, 9, 90, 3)
    frame = spark.createDataFrame(rows, "vec_id int, label bigint, embedding array<double>").repartition(2)
    found = negatives.mine(frame, F.col("vec_id") % 3 == 0, scale=64, positives=2, negatives=4, band=(10, 100))
    assert {tuple(r) for r in found.collect()} == brute_negatives(rows, 3, (2, 4), (10, 100), 64)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(120, 8, 3, 4)
    whole = [*rows, (500, 1, [0.5, 0.25]), (501, 1, []), (502, 2, [0.125] * 19), (504, 1, [-2.5] * 8)]
    odd = [(600, None, [1.0] * 8), (601, 1, None), (602, 1, [nan] * 8), (603, 1, [inf]), (604, 1, [1.0, None]), (605, 2, [-inf])]
    odd += [(None, 1, [1.0] * 8), rows[10], rows[10], (10, rows[10][1] + 1, [0.0] * 8), (600, None, None)]
    schema = "vec_id bigint, label int, embedding array<double>"
    frame = spark.createDataFrame(whole + odd, schema).repartition(3)
    found = {tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 10 == 0).collect()}
    assert found == brute_negatives(whole, 10)
    assert negatives.mine(spark.createDataFrame([], schema), F.col("vec_id") % 10 == 0).collect() == []
