"""op11: weights against plain sums, the draw against a plain sort, odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from kinfold.llm.importance import IMPORTANCE_SQL, bitplanes, crc_of_ranges, exact_sums, resample
from tests.llm.conftest import EXTRA, awkward, prose, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def naive(docs, target, buckets=10_000, most_words=1, least=20, share=(10, 100), seed=2024):
    def counted(text):
        words = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i : i + n]) for n in range(1, most_words + 1) for i in range(len(words) - n + 1)]
        return len(words), Counter(zlib.crc32(r.encode()) % buckets for r in runs)

    held = [(d, *counted(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in held:
        s.update(c)
    for text in target:
        t.update(counted(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for d, n, c in held:
        size = sum(c.values())
        total = sum(k * math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b, k in c.items())
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = total // size if size else 0
        out.append((d, size, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = share[0] * len(able) // share[1]
    ranks = {}
    for k, r in enumerate(able[:drawn], 1):
        ranks.setdefault(r[:4], []).append(k)
    return sorted(((*r[:4], ranks[r[:4]].pop() if ranks.get(r[:4]) else None) for r in out), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_crc_of_ranges():
    raw = np.frombuffer(("short and " + "x" * 300 + " été " * 40).encode(), np.uint8)
    begin = np.array([0, 2, 5, 10, 8, 0, 100])
    end = np.array([5, 2, 9, 310, 80, len(raw), 163])
    assert crc_of_ranges(raw, begin, end).tolist() == [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(begin, end)]
    assert crc_of_ranges(raw, begin[:0], end[:0]).tolist() == []


def test_sums_over_planes_are_exact():
    draw = np.random.default_rng(5)
    for buckets in (1, 63, 64, 1000):
        counts, gains = draw.integers(0, 70_000, (9, buckets)), draw.integers(-12_000, 12_000, buckets)
        counts[draw.random(counts.shape) < 0.7] = 0
        row, bucket = np.nonzero(counts)
        planes = bitplanes(row, bucket, counts[row, bucket], 9, buckets)
        zero, where = np.zeros(buckets, np.int64), np.arange(buckets)
        plus, minus = (bitplanes(zero, where, np.maximum(s * gains, 0), 1, buckets) for s in (1, -1))
        assert exact_sums(planes, plus, minus, 9).tolist() == (counts @ gains).tolist()


@pytest.mark.parametrize("most_words, buckets, share", [(1, 10_000, (10, 100)), (2, 977, (1, 3)), (3, 50, (1, 1))])
def test_equals_plain_python(spark, most_words, buckets, share):
    docs = [(d, t) for d, t, *_ in awkward()] + [(k, prose(k, 10 + k % 40).upper()) for k in range(100, 180)]
    docs += [(200, "a" * 500 + " " + "b1 " * 100)] * 30 + [(201, "x-y_z ½²Ünï\x00q " * 12), (None, None)]
    target = [prose(k, 30) for k in range(400, 420)] + [None, ""]
    df = table(spark, [(d, t, None, None, None) for d, t in docs], extra=True)
    aims = spark.createDataFrame([(t,) for t in target], "text string").selectExpr("*", *[f"1 AS {n}" for n in EXTRA])
    got = found(resample(df, aims, most_words=most_words, buckets=buckets, share=share))
    assert got == naive(docs, target, buckets, most_words, share=share)


def test_equal_rows_fill_no_range_alone(spark):
    docs = [(7, prose(1, 40))] * 900 + [(k, prose(k, 40)) for k in range(100, 400)]
    df = table(spark, [(d, t, None, None, None) for d, t in docs])
    got = found(resample(df, df.filter("doc_id = 7"), share=(1, 2)))
    assert got == naive(docs, [docs[0][1]] * 900, share=(1, 2))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 601))


def test_empty_tables(spark, empty):
    aims = spark.createDataFrame([("some words",)], "text string")
    assert resample(empty, aims).collect() == []
    docs = [(k, prose(k, 30)) for k in range(20)]
    df = table(spark, [(d, t, None, None, None) for d, t in docs])
    assert found(resample(df, aims.limit(0))) == naive(docs, [])


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    theirs = con.execute(f"SELECT doc_id, n_features, weight, score, rank FROM ({IMPORTANCE_SQL})").fetchall()
    mine = found(resample(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")))
    assert mine == sorted(theirs, key=str)
