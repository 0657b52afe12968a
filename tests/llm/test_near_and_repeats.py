import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.classic.dataframe import DataFrame

from kinfold.llm.near_copies import near_copies, overlaps, signatures, similarity, without_near_copies
from kinfold.llm.repeats import multikey_sort, removal_report, repeated_spans, without_repeats
from tests.llm.conftest import awkward, document, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return collections.Counter([tuple(words)] if words else [])
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def classes(rows, threshold=0.8):
    texts = [r[1] or "" for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j] or jaccard(texts[i], texts[j]) >= threshold:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    groups = collections.defaultdict(list)
    for x, r in zip(label, rows):
        groups[x].append(r[0])
    return sorted((str(r[0]), str(min((i for i in groups[x] if i is not None), default=None)), len(groups[x])) for x, r in zip(label, rows))


def edited(text, seed, n):
    words, draw = text.split(" "), np.random.default_rng(seed)
    for k in draw.choice(len(words), n, replace=False):
        words[k] = f"edit{seed}x{k}"
    return " ".join(words)


def group_of_near_copies():
    base = prose(99, 400)
    rows = [document(1000 + k, edited(base, k, 1 + k % 9)) for k in range(40)]
    return rows + [document(2000, base), document(2001, base), document(2002, edited(base, 77, 60))]


@pytest.mark.parametrize("small", [12, 2])
def test_classes_equal_brute_force(spark, monkeypatch, small):
    from kinfold.llm import near_copies as module

    monkeypatch.setattr(module, "SMALL_BUCKET", small)
    monkeypatch.setattr(module, "BLOCK_TEXTS", 5)
    # A chain too: each text is near to the next only.
    chain = [prose(98, 300)]
    for k in range(8):
        chain.append(edited(chain[-1], 300 + k, 6))
    rows = awkward() + group_of_near_copies() + [document(3000 + k, x) for k, x in enumerate(chain)]
    got = near_copies(table(spark, rows, extra=True)).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in got) == classes(rows)


def test_one_of_each_class_stays(spark):
    rows = awkward() + group_of_near_copies()
    kept = without_near_copies(table(spark, rows, extra=True))
    assert kept.columns == table(spark, [], extra=True).columns
    wanted = {(a, n) for _, a, n in classes(rows)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(a for a, _ in wanted)


def test_near_copies_of_nothing(empty):
    assert near_copies(empty).count() == 0 and without_near_copies(empty).count() == 0


def test_similarity_is_exact():
    a = ["a b c d e f g", "x y", "", "r r r r r r r r", "p q r s t"]
    b = ["a b c d e f h", "x y", "", "r r r r r r", "p q r s u"]
    assert np.allclose(similarity(pa.array(a), pa.array(b)), [jaccard(x, y) for x, y in zip(a, b)])


def test_overlaps_equal_pairwise_similarity():
    texts = ["a b c d e f g", "x y", "", "r r r r r r r r", "p q r s t", "a b c d e f g a b c d e f g", "r r r r r r"]
    got = overlaps(texts, texts[::-1])
    assert np.allclose(got, [[jaccard(a, b) for b in texts[::-1]] for a in texts])


def test_signatures_estimate_weighted_similarity():
    # 30 shingles with counts 1 to 8 against other counts.
    draw = np.random.default_rng(4)
    a, b = draw.integers(1, 9, 30), draw.integers(1, 9, 30)
    names = draw.integers(1, 1 << 60, (60, 30)).astype(np.uint64)  # many independent trials
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    shingle = np.concatenate([np.concatenate([np.repeat(n, a), np.repeat(n, b)]) for n in names])
    row = np.repeat(np.arange(120), [a.sum(), b.sum()] * 60)
    points = signatures(shingle, row, 120)
    assert np.isfinite(points).all()
    assert abs((points[::2] == points[1::2]).mean() - expected) < 0.03


def removed(texts, length):
    starts = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if starts[t[p : p + length]] > 1:
                gone[p : p + length] = True
        out.append(gone)
    return out


def expected_report(rows, length=200):
    data = [(r[1] or "").encode() for r in rows]
    out = []
    for r, t, gone in zip(rows, data, removed(data, length)):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        out.append((str(r[0]), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeating():
    """Passages in different surroundings, also overlapping, periodic and shorter by one byte."""
    a, b = prose(1, 60), prose(2, 45)
    rows = awkward() + [
        document(100, prose(3, 30) + a + prose(4, 30)),
        document(101, a[17:] + b),
        document(102, b[5:230] + "é" + a[40:260]),
        document(103, a[:200]),
        document(104, "Z" + a[:199] + "Z"),
        document(105, "ab" * 300),
        document(106, "=" * 260 + prose(5, 20)),
        document(107, a + a),
    ]
    return rows


def test_report_equals_brute_force(spark):
    rows = repeating()
    for most in (200_000, 1):  # in buckets, and by digests
        got = removal_report(table(spark, rows, extra=True), most=most).collect()
        assert sorted((str(r["doc_id"]), *r[1:]) for r in got) == expected_report(rows)
        spans = repeated_spans(table(spark, rows), most=most).collect()
        assert spans and all(s["spans"] == sorted(s["spans"]) for s in spans)


def test_texts_without_their_repeats(spark):
    rows = repeating()
    got = without_repeats(table(spark, rows, extra=True))
    assert got.columns == table(spark, [], extra=True).columns
    data = [(r[1] or "").encode() for r in rows]
    wanted = []
    for r, t, gone in zip(rows, data, removed(data, 200)):
        wanted.append(r[1] if not gone.any() else np.frombuffer(t, np.uint8)[~gone].tobytes().decode("utf-8", "ignore"))
    assert sorted(map(str, wanted)) == sorted(str(r["text"]) for r in got.collect())


def test_repeats_of_nothing(empty):
    assert removal_report(empty).count() == 0 and without_repeats(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(min_size=16, max_size=16).map(lambda b: bytes(x % 3 * 120 for x in b))), max_size=40))
def test_multikey_sort(rows):
    group = np.array([g for g, _ in rows], np.int64)
    words = np.frombuffer(b"".join(b for _, b in rows), ">u8").reshape(-1, 2).astype(np.uint64)
    order, common = multikey_sort(words, group)
    keys = [rows[k] for k in order]
    assert keys == sorted(rows)
    for k, (one, two) in enumerate(zip(keys, keys[1:]), 1):
        same = next((i for i in range(16) if one[1][i] != two[1][i]), 16) if one[0] == two[0] else -1
        assert common[k] == same


def test_copies_reach_a_bucket_once(spark, monkeypatch):
    from kinfold.llm import repeats

    seen = []
    monkeypatch.setattr(repeats, "STEP", 50)
    real = DataFrame.sortWithinPartitions

    def sort(self, *columns):
        seen.append(real(self, *columns))
        return seen[-1]

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", sort)
    text = prose(1, 200)
    rows = [document(k, text) for k in range(300)] + [document(999, text[:600] + " other " + text[600:])]
    removed = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in repeats.removal_report(table(spark, rows)).collect()}
    assert all(removed[k] == (len(text), len(text)) for k in range(300)) and removed[999][0] > removed[999][1] > 1000
    dealt = [tuple(r) for r in seen[0].select("token", "strings").collect()]
    assert dealt and len(dealt) == len(set(dealt))
