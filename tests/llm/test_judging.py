import collections
import math
import re
import zlib

import numpy as np
import pytest

from kinfold.llm.language import identify
from kinfold.llm.outliers import judge, robust_fits
from kinfold.llm.quality import LABELLERS, classify, estimate, pattern_of, votes_of
from tests.llm.conftest import EXTRA, awkward, document, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = {"en": ("th", "ing", "ou", "wh"), "fr": ("é", "eau", "oi", "que"), "de": ("sch", "ung", "ä", "ver")}


def speech(lang, seed, n):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(SYLLABLES[lang], draw.integers(1, 4))) for _ in range(n))


def test_languages(spark):
    rows = [document(k, speech(lang, k, 5 + k % 80), lang) for k, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [document(500, None), document(501, "12 34 !?"), document(502, ""), document(None, speech("fr", 3, 40), "fr")]
    rows += [document(503, speech("de", 4, 30_000), None), document(504, speech("de", 5, 40), None)] * 2
    got = identify(table(spark, rows, extra=True), sample=60).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        by_id[r["doc_id"]].append((r["lang_pred"], r["score"]))
    for k in (500, 501, 502):
        assert by_id[k] == [("und", 0.0)]
    for k in (503, 504):
        assert by_id[k][0] == by_id[k][1] and by_id[k][0][0] == "de"
    held = [(r["lang_pred"], rows[r["doc_id"]][2]) for r in got if r["held_out"] and r["doc_id"] < 180]
    assert len(held) > 20 and np.mean([a == b for a, b in held]) > 0.95


def test_nothing_to_learn_languages_from(spark, empty):
    assert identify(empty).count() == 0
    rows = [(r["lang_pred"], r["score"]) for r in identify(table(spark, [document(1, "some text", None)])).collect()]
    assert rows == [("und", 0.0)]


def junk(k):
    words = prose(k, 60).split()
    return [" ".join(w + "***" for w in words), " ".join(w.upper() + "!!" for w in words), " | ".join(words), " ".join(w for w in words for _ in range(6))][k % 4]


def test_quality(spark):
    good = [document(k, prose(k, 30 + k)) for k in range(120)]
    bad = [document(1000 + k, junk(k)) for k in range(40)]
    rows = good + bad + awkward()
    got = classify(table(spark, rows, extra=True))
    assert got.columns == [c for c in table(spark, [], extra=True).columns if c not in ("score", "kept")] + ["score", "weak_label", "kept"]
    got = got.collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[k] for k in range(120) if k not in (0, 1, 2, 3, 8, 9))  # ids that the awkward rows use too
    assert sum(kept[1000 + k] for k in range(40)) == 0
    assert not any(r["kept"] or r["score"] for r in got if not WORD.search(r["text"] or ""))


def test_quality_of_nothing(spark, empty):
    assert classify(empty).count() == 0
    assert [r["kept"] for r in classify(table(spark, [document(1, None), document(1, None)])).collect()] == [False, False]


def test_estimate_recovers_accuracies():
    draw = np.random.default_rng(2)
    truth = draw.random(20_000) < 0.8
    rates = np.linspace(0.02, 0.05, len(LABELLERS))  # wrong objections to good texts
    votes = np.where(truth[:, None], draw.random((20_000, len(LABELLERS))) >= rates, draw.random((20_000, len(LABELLERS))) >= 0.6)
    votes = np.where(draw.random(votes.shape) < 0.2, 0, 2 * votes.astype(int) - 1).astype(np.int8)
    patterns, counts = np.unique(pattern_of(votes), return_counts=True)
    good, given, share = estimate(votes_of(patterns), counts.astype(float))
    assert abs(share - 0.8) < 0.02
    assert np.abs(given[:, 1, 0] - rates).max() < 0.02 and np.abs(given[:, 0, 0] - 0.6).max() < 0.05
    found = dict(zip(patterns, good))
    assert np.mean([(found[p] >= 0.5) == t for p, t in zip(pattern_of(votes), truth)]) > 0.97


def counts_of(text):
    text = text or ""
    words, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_outliers(spark):
    rows = [document(k, prose(k, 60 + k % 50), "en", "ab"[k % 2]) for k in range(100, 400)]
    rows += [document(1000 + k, prose(k, 60).replace(" ", "*** "), "en", "a") for k in range(12)]
    rows += [document(2000, "same line here\n" * 30), document(2001, "x\ny\nx\n \n \nx")] + awkward()
    got = judge(table(spark, rows, extra=True), least_rows=50).collect()
    def expected(r):
        n, chars, symbols, lines, words = counts_of(r[1])
        return str(r[0]), n, chars, symbols, lines, words, n < 10 or 100 * words > 20 * n

    assert sorted((str(r[0]), *r[1:6], r["base_failed"]) for r in got) == sorted(map(expected, rows))
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[k] for k in range(100, 400)) and not any(kept[1000 + k] for k in range(12))
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_fits_ignore_a_quarter_of_bad_rows(spark):
    draw = np.random.default_rng(5)
    clean = draw.multivariate_normal([1, 2, 3, 4, 5], 0.5 * np.eye(5) + 0.3, 1500)
    bad = draw.normal(20, 1, (350, 5))
    rows = [("g", *(np.round(1024 * x).astype(int).tolist())) for x in np.vstack([clean, bad])]
    fit = robust_fits(spark.createDataFrame(rows, "grp string, x0 long, x1 long, x2 long, x3 long, x4 long")).first()
    assert np.abs(np.array(fit["center"]) - clean.mean(0)).max() < 0.15
    shape = np.linalg.inv(np.array(fit["precision"]).reshape(5, 5)) * fit["scale"]
    assert np.abs(shape - np.cov(clean.T)).max() < 0.25


@pytest.mark.parametrize("copied", [130, 190])  # 30 and 39 of a hundred rows
def test_copied_junk_in_one_group(spark, copied):
    rows = [document(k, prose(k, 60 + k % 50)) for k in range(300)]
    rows += [document(1000 + k, prose(5, 60).replace(" ", "*** ")) for k in range(copied)]
    rows += [document(2000 + k, prose(k, 60 + k % 50), "en", "b") for k in range(100)]
    kept = {r["doc_id"]: r["kept"] for r in judge(table(spark, rows)).collect()}
    assert not any(kept[1000 + k] for k in range(copied))
    assert all(kept[k] for k in [*range(300), *range(2000, 2100)])


def test_small_group_of_another_language(spark):
    def long_words(k):
        words = prose(k, 240).split()
        return " ".join("".join(w.strip(",.") for w in words[i : i + 4]) for i in range(0, 240, 4))

    rows = [document(k, prose(k, 60 + k % 50)) for k in range(300)]
    rows += [document(1000 + k, long_words(k), "fi", "ab"[k % 2]) for k in range(60)]
    rows += [document(2000 + k, long_words(100 + k).replace(" ", "*** "), "fi", "a") for k in range(5)]
    kept = {r["doc_id"]: r["kept"] for r in judge(table(spark, rows)).collect()}
    assert all(kept[k] for k in [*range(300), *range(1000, 1060)])
    assert not any(kept[2000 + k] for k in range(5))


def test_outliers_of_nothing(empty):
    assert judge(empty).count() == 0
