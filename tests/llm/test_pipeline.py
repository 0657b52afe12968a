import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import corpus_pipeline
from kinfold.llm.shared import stored
from tests.llm.conftest import awkward, document, prose, table
from tests.llm.test_judging import junk
from tests.llm.test_near_and_repeats import edited, jaccard


def rows():
    base, passage = prose(900, 300), prose(901, 90)
    out = [document(k, prose(k, 30 + k % 200), "en", "abcd"[k % 4]) for k in range(100, 300)]
    out += [document(1000 + k, junk(k)) for k in range(30)]
    out += [document(2000 + k, edited(base, k, 3) if k else base) for k in range(6)]
    out += [document(3000 + k, f"{prose(910 + k, 40)}\n{passage}\n{prose(920 + k, 40)}", "en", "b") for k in range(4)]
    return out + awkward(), passage


def test_stages(spark):
    all_rows, passage = rows()
    docs = table(spark, all_rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, ""), "test-stage")
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
            docs = after
            kept[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in found} for name, found in kept.items()}
    judged, single, cut, mixed = (kept[n] for n, _ in corpus_pipeline.STAGES[:4])
    assert not ids["quality classifier"] & set(range(1000, 1030))
    assert ids["quality classifier"] >= set(range(100, 300)) | set(range(2000, 2006)) | set(range(3000, 3004))
    assert len(ids["MinHash near-dedup"] & set(range(2000, 2006))) == 1
    texts = [r["text"] for r in single]
    assert all(jaccard(a, b) < 0.8 for i, a in enumerate(texts) for b in texts[:i] if abs(len(a) - len(b)) < 0.3 * len(a))
    assert len(cut) == len(single) and not any(passage[10:-10] in (r["text"] or "") for r in cut)
    assert all(r["n_chars"] == len(r["text"]) for r in cut)
    assert 1.3 < sum(len(r["text"].split()) for r in mixed) / sum(len(r["text"].split()) for r in cut) < 1.7
    packed = after.collect()
    assert {r["doc_id"] for r in packed} == ids["mixing sources to target weights"]
    assert len(packed) >= len(mixed)


def test_stages_give_stored_rows_and_texts_travel_once(spark):
    docs = table(spark, rows()[0])
    judged = corpus_pipeline.classify(docs)
    assert "MapInArrow" in judged._jdf.queryExecution().toString() and "_text_" not in judged._jdf.queryExecution().toString()
    # Whoever writes the first stage's result takes no Arrow batches of thousands of texts.
    assert "MapInArrow" not in corpus_pipeline.quality(spark, docs, "")._jdf.queryExecution().toString()


def test_run_equals_its_stages_and_takes_nothing(spark, tmp_path):
    table(spark, rows()[0]).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").columns[0] == "doc_id"
    table(spark, []).write.parquet(f"file://{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0


def test_stored_tables_are_compressed_well(spark):
    texts = table(spark, [document(k, prose(k, 400)) for k in range(40)]).coalesce(1)
    kept = stored(texts, "test-codec")
    (path,) = (f.removeprefix("file:").replace("///", "/") for f in kept.inputFiles())
    group = pq.ParquetFile(path).metadata.row_group(0)
    assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}
    assert sorted(kept.collect()) == sorted(texts.collect())


def test_mixture_keeps_no_copy_of_the_texts(spark):
    repeated = [document(5000, prose(950, 40), "en", "d")] * 5
    docs = stored(table(spark, rows()[0] + repeated), "test-mix")
    mixed = corpus_pipeline.mixture(spark, docs, "")
    assert set(docs.inputFiles()) <= set(mixed.inputFiles())
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    # Read twice, it is the same rows, and as often as the mix decides on each document.
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times == Counter(r["doc_id"] for r in stored(mixed, "test-mixed").collect())
    words = Counter()
    for r in corpus_pipeline.mix(docs)[1].collect():
        words[r["doc_id"]] += r["taken"]
    sizes = Counter()
    for r in mixed.collect():
        sizes[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {k: n for k, n in sizes.items() if n} == {k: n for k, n in words.items() if n}
