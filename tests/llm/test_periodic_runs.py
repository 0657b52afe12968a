"""op12: runs against a naive search, transforms against plain sums, planted texts and odd input against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kinfold.llm.periodic import PRIME, digests, find_runs, inverse_transform, planted, report, squared_differences, transform
from tests.llm.conftest import awkward, prose, table


def naive_runs(words, least=12):
    """For every period, all stretches of words that equal those a period later."""
    number = {}
    w, out = np.array([number.setdefault(x, len(number)) for x in words], np.int64), []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        for s, e in zip(np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])):
            if e + q - s >= max(least, 2 * q):
                part = w[s : e + q]
                if not any((part[r:] == part[:-r]).all() for r in range(1, q)):
                    out.append((int(s), int(e + q - s), q))
    return sorted(out)


def words_of(text):
    return (text or "").encode().split()


def naive_planted(doc_id, text):
    words = words_of(text)
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 or not words:
        return words
    g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def naive_row(doc_id, words):
    runs = naive_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def key(row):
    return tuple((x is None, x) if not isinstance(x, str) else x for x in row)


def test_transform_and_squares():
    draw = np.random.default_rng(3)
    for size in (2, 8, 64):
        x = draw.integers(0, PRIME, (4, size)).astype(np.uint64)
        assert (inverse_transform(transform(x.copy())) == x).all()
    blocks = draw.integers(0, PRIME, (5, 4)).astype(np.uint64)
    windows = draw.integers(0, PRIME, (5, 11)).astype(np.uint64)
    windows[2, 3:7] = blocks[2]
    got = squared_differences(blocks, windows)
    for r in range(5):
        for o in range(8):
            assert got[r, o] == sum((int(x) - int(y)) ** 2 for x, y in zip(blocks[r], windows[r, o : o + 4])) % PRIME
    assert got[2, 3] == 0


def texts_of_all_kinds(draw):
    n = draw.randint(0, 180)
    kind = draw.randrange(6)
    if kind == 0:
        return [draw.randint(0, 1) for _ in range(n)]
    if kind == 1:
        return [draw.randint(0, 4) for _ in range(n)]
    if kind == 2:
        return (([0] * draw.randint(1, 30) + [1]) * 12)[:n]
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    base = [draw.randint(0, 5) for _ in range(draw.randint(1, 70))]
    w = [base[i % len(base)] for i in range(n)]
    for _ in range(draw.randint(0, 3) if kind == 4 else 0):
        if w:
            w[draw.randrange(n)] = 9
    return w


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_naive_search(seed):
    draw = random.Random(seed)
    texts = [texts_of_all_kinds(draw) for _ in range(draw.randint(0, 6))]
    flat = np.array([x for t in texts for x in t], np.int64)
    assert find_runs(flat, np.cumsum([0, *map(len, texts)])) == [naive_runs(t) for t in texts]


def test_long_texts_of_one_word_and_of_long_periods():
    n = 300_000
    period = 40_000
    texts = [[7] * n, [i % period for i in range(3 * period + 5)]]
    found = find_runs(np.array([x for t in texts for x in t]), np.cumsum([0, *map(len, texts)]))
    assert found == [[(0, n, 1)], [(0, 3 * period + 5, period)]]


def test_report_equals_plain_python(spark, docs):
    plain = [(d, t) for d, t, *_ in awkward()]
    got = digests(report(docs)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted((naive_row(d, words_of(t)) for d, t in plain), key=key)


def test_planted_texts(spark):
    rows = [(k, prose(k, 15 + k % 50)) for k in range(150)]
    rows += [(None, prose(1, 30)), (5, None), (7, ""), (9, " \t "), (11, "a\x0bb\x0cc\rd\ne  f\xa0g h " * 9), (11, "a\x0bb\x0cc\rd\ne  f\xa0g h " * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS runs", "2 AS start")
    changed = df.withColumn("text", planted(df["doc_id"], df["text"]))
    assert {(r["doc_id"], tuple(words_of(r["text"]))) for r in changed.collect()} == {(d, tuple(naive_planted(d, t))) for d, t in rows}
    got = digests(report(changed)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted((naive_row(d, naive_planted(d, t)) for d, t in rows), key=key)
    assert sum(r["n_runs"] > 0 for r in got) > 10


def test_collapsed_text_keeps_one_period(spark):
    period = " ".join(f"w{k}" for k in range(7))
    df = spark.createDataFrame([(1, f"start {period} {period} {period} end")], "doc_id bigint, text string")
    (row,) = report(df).collect()
    assert row["collapsed"] == f"start {period} end"
    assert [tuple(r) for r in row["runs"]] == [(1, 21, 7)]


def test_empty_table(spark, empty):
    assert digests(report(empty)).collect() == []


def test_no_rows_of_interest(spark):
    df = table(spark, [(1, None, None, None, None)])
    (row,) = digests(report(df)).collect()
    assert tuple(row) == naive_row(1, [])
