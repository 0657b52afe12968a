import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm import tokens
from kinfold.llm.orc_tokens import read_tokens, round_trip, write_tokens
from kinfold.llm.packing import pack, pack_histogram, slots
from kinfold.llm.tokens import default_vocabulary, encoder
from tests.llm.conftest import awkward, document, prose, table


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(default_vocabulary())
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ENCODE = encoder(default_vocabulary(), 0)
PIECES = [*"ab é's .,!*|\n\t \x00\x85日1½²́ªǅ\U0001f600<>", "<|endoftext|>", " the", "word", "x" * 300, "\u2003", "\u3000", "été,", "don't "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=5))
def test_encoder_equals_the_library(library, texts):
    ids, at = ENCODE(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library(t) + [0] for t in texts]


def test_memory_begins_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encode = encoder(default_vocabulary(), 0)
    for seed in range(6):
        texts = [prose(seed, 60), "", "y" * 1000, "two  spaces", None, prose(seed + 1, 30)]
        ids, at = encode(pa.array(texts, pa.string()).slice(1))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library(t) + [0] for t in texts[1:]]


def test_vocabulary_is_read_once_in_a_worker_and_odd_signs_are_found_however_rare(library):
    first = tokens._library(default_vocabulary())
    encode = encoder(default_vocabulary(), 0)
    assert tokens._library(default_vocabulary()) is first
    rare = [prose(3, 400), prose(4, 200) + "\u2003" + prose(5, 200), "a" * 999 + "<|endoftext|>" + "b" * 999, prose(6, 400) + "\t"]
    for texts in (rare, [t + "\t\x00 \xa0\u3000<<" * 60 for t in rare]):
        ids, at = encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library(t) + [0] for t in texts]


def expected_rows(library):
    rows, start = [], 0
    for doc, text, *_ in sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library(text) + [2]
        rows.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return rows


def test_round_trip(docs, library):
    got = [tuple(r) for r in round_trip(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_rows(library)


def test_round_trip_of_nothing(empty):
    assert round_trip(empty).count() == 0


def test_reads_by_id_reach_the_files(spark, docs, tmp_path, library):
    write_tokens(docs, f"file://{tmp_path}/t", stride=1000)
    some = read_tokens(spark, f"file://{tmp_path}/t").filter(F.col("doc_id") == 12)
    assert "EqualTo(doc_id,12)" in some._jdf.queryExecution().toString()
    row = some.first()
    assert row["ids"] == library(dict((r[0], r[1]) for r in awkward())[12]) + [2]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=20))
def test_patterns_hold_every_piece_once(histogram):
    patterns = pack_histogram(histogram, 40)
    placed = collections.Counter()
    for packs, pattern in patterns:
        assert packs > 0 and sum(length * copies for length, copies in pattern) <= 40
        for length, copies in pattern:
            placed[length] += packs * copies
    assert placed == collections.Counter(histogram)
    assert len(patterns) <= 3 * len(histogram) + 1
    ranks = collections.defaultdict(list)
    for length, first, last, *_ in slots(patterns):
        ranks[length] += range(first, last + 1)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}


def test_patterns_fill_well():
    draw = np.random.default_rng(1)
    histogram = collections.Counter(draw.integers(1, 1025, 20_000).tolist())
    patterns = pack_histogram(histogram, 1024)
    packs = sum(n for n, _ in patterns)
    assert sum(k * n for k, n in histogram.items()) / (1024 * packs) > 0.985
    assert pack_histogram({512: 7}, 1024) == [(3, ((512, 2),)), (1, ((512, 1),))]
    with pytest.raises(ValueError):
        pack_histogram({0: 1}, 8)


def test_pack(docs, library):
    rows = pack(docs, size=64).collect()
    sequences, seen = collections.defaultdict(list), collections.Counter()
    texts = collections.defaultdict(list)
    for doc, text, *_ in awkward():
        texts[doc].append(library(text) + [0])
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        whole = texts[r["doc_id"]][0]
        assert r["doc_tokens"] == len(whole) and r["ids_crc32"] == crc(whole[r["start"] : r["start"] + r["length"]])
        seen[r["doc_id"], r["start"], r["length"]] += 1
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    wanted = collections.Counter((d, k, min(64, len(x) - k)) for d, all in texts.items() for x in all for k in range(0, len(x), 64))
    assert seen == wanted


def test_pack_nothing(empty):
    assert pack(empty).count() == 0


END = "<|endoftext|>"


def holding_added_tokens():
    texts = [f"a {END} b", f"a{END}b", END, f" {END}", f"{END}\n{END} x", f"x\t{END}\n", f"{prose(3, 60)} {END} {prose(4, 60)}", "<|endoftext |>", prose(5, 40)]
    return [document(100 + k, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def plain_library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(default_vocabulary())
    return lambda text: found.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([END, "<|", "|>", "endoftext", "a", " ", "\n", ".", "é", "\t"]), max_size=12).map("".join), max_size=5))
def test_added_tokens_equal_the_library(plain_library, texts):
    ids, at = ENCODE(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain_library(t) + [0] for t in texts]


def test_added_tokens_in_documents(spark, plain_library):
    assert plain_library(f"a {END} b") == [64, 220, 50256, 275]
    rows, start = [], 0
    for doc, text, *_ in holding_added_tokens():
        ids = plain_library(text) + [2]
        rows.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    docs = table(spark, holding_added_tokens())
    got = [tuple(r) for r in round_trip(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == rows
    whole = {d: plain_library(t) + [0] for d, t, *_ in holding_added_tokens()}
    packed = pack(docs, size=1024).collect()
    assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packed} == {d: (len(x), crc(x)) for d, x in whole.items()}


def test_other_stages_free_the_words(spark):
    """Words remembered by a worker do not stay when it signs or cuts texts for another operator."""
    import sys

    from kinfold.llm import near_copies, shared, tokens

    tokens._memory("some vocabulary").number[b"word"] = 0
    shared.forget_words()
    assert "kinfold_task_memory" not in sys.modules and not tokens._memory("some vocabulary").number
    shared.forget_words()
    assert near_copies.SIGNED_BYTES <= shared.CHUNK_BYTES


def test_few_remembered_words_change_nothing():
    texts = pa.array([prose(k, 40) for k in range(6)])
    few = encoder(default_vocabulary(), 0, 1)
    for _ in range(2):
        assert all((a == b).all() for a, b in zip(few(texts), ENCODE(texts)))
