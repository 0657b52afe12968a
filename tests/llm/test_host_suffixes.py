"""Pages judged by the suffix array of their host, against the longest repeats found by brute force."""

import random
from collections import defaultdict
from math import ceil

from kinfold.llm import pages
from kinfold.llm.pages import LEAST_PAGES, LEAST_SHARE, main_text, read_page

from tests.llm.conftest import prose

LEAST = 6


def brute(rows):
    """Text of each page: tokens go that lie in a longest repeat of its host's distinct pages."""
    hosts = defaultdict(dict)
    for _, url, html in rows:
        hosts[url and url.split("/")[2]][html or ""] = None
    texts = {}
    for host, held in hosts.items():
        read = {h: read_page(h) for h in held}
        streams = {h: " ".join(p.furniture + p.open).split() for h, p in read.items()}
        enough = max(LEAST_PAGES, ceil(LEAST_SHARE * len(held) - 1e-9))

        def pages_with(run):
            return sum(any(s[k : k + len(run)] == run for k in range(len(s) - len(run) + 1)) for s in streams.values())

        for h, page in read.items():
            own, gone = streams[h], set()
            for k in range(len(own) - LEAST + 1):
                size = LEAST - 1
                while k + size < len(own) and pages_with(own[k : k + size + 1]) >= enough:
                    size += 1
                if size >= LEAST:
                    gone.update(range(k, k + size))
            at, blocks = len(" ".join(page.furniture).split()), list(zip(page.article_at, page.article))
            for place, block in zip(page.open_at, page.open):
                words, runs = block.split(), [[]]
                for k, w in enumerate(words):
                    runs[-1].append(w) if at + k not in gone else runs.append([])
                at += len(words)
                if page.has_article:
                    runs = [r for r in runs if len(r) >= LEAST and len(held) >= LEAST_PAGES and len(own) >= LEAST]
                kept = " ".join(w for r in runs for w in r)
                blocks += [(place, kept)] if kept else []
            texts[host, h] = "\n\n".join(b for _, b in sorted(blocks))
    return texts


def awkward():
    draw = random.Random(5)
    pool = [prose(k, draw.randint(3, 25)) for k in range(12)]
    rows = []
    for k in range(60):
        parts = [f"<p>{draw.choice(pool) if draw.random() < 0.6 else prose(100 + 10 * k + j, draw.randint(1, 14))}</p>" for j in range(draw.randint(0, 4))]
        parts += [f"<nav>{draw.choice(pool)}</nav>"] if k % 4 == 0 else []
        parts += [f"<article><h1>t{k}</h1><p>{draw.choice(pool)}</p></article>"] if k % 3 == 0 else []
        draw.shuffle(parts)
        host = draw.choice(["a", "a", "b", "c", f"single{k}"])
        rows.append((k, None if k % 17 == 0 else f"https://{host}/{k}", "".join(parts)))
    return rows + rows[:9] + [(99, "https://a/none", None), (None, "https://b/x", rows[1][2])]


def test_intervals_equal_longest_repeats(spark):
    rows = awkward()
    want = brute(rows)
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        by_id = defaultdict(set)
        for i, url, html in rows:
            by_id[i].add(want[url and url.split("/")[2], html or ""])
        got = main_text(df).collect()
        assert len(got) == len(rows)
        for r in got:
            assert {r["text"]} == by_id[r["page_id"]]


def test_blocks_beside_articles_are_judged(spark):
    footer, note = "all rights of this fine site are kept by us", prose(3, 12)
    page = "<p>{}</p><article><p>{}</p></article><p>{}</p><div>Share</div>"
    rows = [(k, f"https://h/{k}", page.format(footer, prose(k, 20), f"{note} {k}" if k == 2 else footer)) for k in range(4)]
    rows += [(10 + k, f"https://few/{k}", page.format(prose(50 + k, 9), prose(k, 20), footer)) for k in range(2)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in (0, 1, 3)] == [prose(k, 20) for k in (0, 1, 3)]
    assert got[2].split("\n\n")[0] == prose(2, 20) and got[2].split("\n\n")[1].startswith(note)
    assert [got[10 + k] for k in range(2)] == [prose(k, 20) for k in range(2)]  # too few pages to judge by


def test_neighbours_are_counted_across_ranges_and_batches(spark):
    rows = [(h, bytes([h is None, 0, 0, s] * 6), p, p == 7) for h in ("a", None) for s in range(3) for p in range(20 * s + 1)]
    rows += rows[:30]  # repeated rows
    df = spark.createDataFrame(rows, "host string, suffix binary, page bigint, judged boolean")
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    for size, parts in (("7", "9"), ("10000", "1")):
        try:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {(r["host"], r["suffix"][3]): (r["n"], r["judged"]) for r in pages._intervals(df, 6).filter(f"n >= {LEAST_PAGES}").collect()}
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert got == {(h, s): (20 * s + 1, True) for h in ("a", None) for s in (1, 2)}
