"""Repeated ids, column names that clash, and parts of pages whose names are the article's subject."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riverstat.llm import language, lines, minmax, packing, pages, polytope, toxicity
from riverstat.llm.common import shared_folder


def plain_links(rows, least=0.98):
    """n_links and component_id of each row by comparing all pairs."""
    n = len(rows)
    unit = []
    for _, vector, label in rows:
        ok = label is not None and vector and all(c is not None and np.isfinite(c) for c in vector) and any(vector)
        x = np.array(vector, dtype=float) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    top, links = list(range(n)), [0] * n

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if float(unit[i] @ unit[j]) >= least:
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    smallest = {}
    for i in range(n):
        smallest[find(i)] = min(smallest.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], smallest[find(i)], rows[i][0] == smallest[find(i)]) for i in range(n))


@pytest.mark.parametrize("d", [16, 64])
def test_links_of_repeated_ids(spark, d):
    rng = np.random.default_rng(d)
    rows = []
    for group in range(6):
        centre = rng.normal(size=d)
        for _ in range(8):
            vector = centre + rng.normal(size=d) * np.linalg.norm(centre) / np.sqrt(d) * rng.choice([0.0, 0.02, 0.08, 0.1])
            rows.append((int(rng.integers(20)), vector.tolist(), group % 3))
    rows += [(int(rng.integers(20)), rng.normal(size=d).tolist(), int(rng.integers(3))) for _ in range(30)]
    rows += [(1, None, 1), (1, [0.0] * d, 1), (2, rows[0][1], None), (3, rows[0][1], 0)]
    near = [abs(float(np.dot(a, b)) / np.linalg.norm(a) / np.linalg.norm(b) - 0.98) for _, a, _ in rows[:78] for _, b, _ in rows[:78]]
    assert min(near) > 1e-9
    table = spark.createDataFrame(
        [(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, label int, rep int, n int, least int")
    found = polytope.links(table, block=7).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == plain_links(rows)


def test_stages_keep_columns_with_their_names(spark, tmp_path):
    names = "_row _component _lines _language _toxicity rep bucket a b n t u text_ component_id".split()
    rows = [(i, f"the quick brown fox number {i // 2} jumps over a lazy dog\nshared line", "en", "s", 7, *range(len(names)))
            for i in range(24)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    spark.createDataFrame([(i, 0) for i in range(24)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        made = kept.select("doc_id", *names).collect()
        assert made and all(tuple(r)[1:] == tuple(range(len(names))) for r in made), name
    assert corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).count() == 12


def test_large_filters_are_asked_where_they_are(spark):
    rows = [(i, f"only {i}\nShared\n\n shared \nother {i % 3}") for i in range(40)] + [(40, None), (41, "x")]
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, _t int, shard int")
    index = lines.build(docs, shard_keys=4)
    sent = lines.drop_shared(index, docs).orderBy("doc_id").collect()
    assert sent == lines.drop_shared(index, docs, send=-1).orderBy("doc_id").collect()
    assert [r.lines.n_dropped for r in sent[:3]] == [4, 4, 4] or sent[0].lines.n_dropped >= 3
    plan = lines.drop_shared(index, docs, send=-1)
    assert plan.columns == [*docs.columns, "lines"]


TEXT = "One, two and three. Then, as ever, four. " * 6


@pytest.mark.parametrize("part", [
    f'<section class="social-science"><p>{TEXT}</p></section>', '<p class="share-price">The share price rose, by five.</p>',
    f'<section id="related-work"><p>{TEXT}</p><p>{TEXT}</p></section>',
])
def test_subjects_stay(part):
    page = f"<body><article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p>{part}</article></body>"
    assert pages.main_text(page).count("\n\n") == 2 + part.count("<p")


@pytest.mark.parametrize("part", [
    "<div class='share-buttons'><a>Mail</a><a>Copy</a></div>", f"<div id='comments'><p>{TEXT}</p></div>",
    f"<div class='comment-list'><p>{TEXT}</p></div>", "<ul class='related-posts'><li>Other</li><li>More</li></ul>",
])
def test_notices_and_comments_go(part):
    page = f"<body><article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p>{part}</article></body>"
    assert pages.main_text(page).count("\n\n") == 2


def test_pages_with_many_marks_and_levels():
    started = time.perf_counter()
    blocks = "".join(f"<p class='related-x'>Block {i}, of some length, as ever. {'word ' * 20}</p>" for i in range(8000))
    assert pages.main_text(f"<article><p>Intro, this is it.</p>{blocks}</article>").count("\n\n") == 8000
    assert pages.main_text("<div>" * 32_000 + "deep, text." + "</div>" * 32_000) == "deep, text."
    assert time.perf_counter() - started < 10


def test_words_are_told_apart():
    texts = [b"", b" \n ", b"a b a", b"ab", b"a\nb  ab ", b"x" * 10_000 + b" " + b"x" * 9_999, "é É".encode()]
    words, number, ends = packing.distinct_words(texts)
    found = [words[i] for i in number]
    assert [found[a:b] for a, b in zip([0, *ends[:-1]], ends)] == [[w for w in t.replace(b"\n", b" ").split(b" ") if w] for t in texts]
    assert len(set(words)) == len(words)
    assert [len(x) for x in packing.distinct_words([])] == [0, 0, 0] and packing.distinct_words([b"", b""])[0] == []


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), {"spark.sql.warehouse.dir": "file:/warehouse/", **conf}


def test_shared_folder_is_named_on_a_cluster():
    named = {"spark.checkpoint.dir": "hdfs://shared/cp"}
    assert shared_folder(_Session("spark://host:7077", **named)) == "hdfs://shared/cp"
    assert shared_folder(_Session("local[2]")) == "file:/warehouse/_checkpoints"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077"))
