"""The registered corpus queries against their SQL, and samples that stay bounded."""

import duckdb
import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from kinfold.llm import language, quality
from tests.llm.conftest import prose, table
from tests.oracle import TABLES, shape

FOLDER = "/root/testdata/sf0.001"
#: Trained models, hash families, tokenizer ids, markup and runs are beyond SQL; each has a test of its own here.
WITHOUT_SQL = {
    "op1_byte_network_language", "op3_weak_label_quality", "op4_bag_minhash", "op5_shortest_pack_first", "op6_orc_tokens",
    "op7_host_suffix_array", "op9_robust_outliers", "op10_sparse_suffix_array", "op12_block_convolution_runs", "pipeline",
}
NAMES = {n for n in queries() if n.startswith("op") or n == "pipeline"}


def test_declared():
    assert NAMES - set(oracle_sql()) == WITHOUT_SQL and len(NAMES) == 14


@pytest.mark.parametrize("name", sorted(NAMES - WITHOUT_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    a, b = shape(queries()[name](spark, FOLDER).toPandas()), shape(con.execute(oracle_sql()[name]).df())
    assert list(a.columns) == list(b.columns) and a.equals(b)


def hot_rows():
    rows = [(k, prose(k, 40), "en" if k % 2 else "fr", "a", 1) for k in range(400)]
    rows += [(None, prose(900, 40), "en", "a", 1)] * 300 + [(7, prose(901, 40), "fr", "a", 1)] * 300
    return rows + [(k, "$$$ ### 123 !!! " * 5, "en", "a", 1) for k in range(1000, 1040)]


def test_quality_sample_is_bounded(spark, monkeypatch):
    seen = []
    real = quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda rows: seen.append(len(rows)) or real(rows))
    quality.classify(table(spark, hot_rows()), sample=5_000).count()
    assert not seen or seen[0] <= 442  # 440 different pairs of id and text, and the two repeated ones


def test_language_sample_is_bounded(spark, monkeypatch):
    seen = []
    real = language.train
    monkeypatch.setattr(language, "train", lambda w, *a, **k: seen.append(len(w)) or real(w, *a, **k))
    df = table(spark, hot_rows())
    net = language.learn(df.select("doc_id", "text", "lang"), sample=5_000)
    assert net is not None and seen[0] <= 4 * 441


def test_letters_decide_whether_there_is_a_language(spark):
    rows = [(k, prose(k, 60), "en" if k % 2 else "fr", None, 1) for k in range(60)]
    odd = [(1000, "½ ² ³ 12", None, None, 1), (1001, "ª", None, None, 1), (1002, "", None, None, 1), (1003, "日", None, None, 1), (1004, None, None, None, 1)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(table(spark, rows + odd)).collect()}
    assert [got[k] == "und" for k in range(1000, 1005)] == [True, False, True, False, True]


def test_network_judges_a_window_alike_in_any_batch():
    draw = np.random.default_rng(0)
    windows = draw.integers(97, 123, (40, language.WINDOW)).astype(np.uint8)
    net = language.train(windows, np.arange(40) % 2, ["a", "b"])
    got = net.log_odds(windows[:5])
    assert got.shape == (5, 2)
    assert np.allclose(got, np.concatenate([net.log_odds(w[None]) for w in windows[:5]]), atol=1e-4)
