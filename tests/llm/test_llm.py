"""The numbered operators against brute force on small tables, and the cases their docstrings define."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riverstat.llm import bpe, language, lines, minmax, packing, pages, polytope, queries, sharding, toxicity, vafile

TABLES = "/root/testdata/sf0.001"
RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "=" * 5000), (5, "a  b c  \n\n d's É日本 <|endoftext|>"), (6, "Word " * 9000),
    (7, "same text here"), (7, "same text here"), (None, "x"), (8, "1 2 3"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, with columns whose names the operators use themselves."""
    extra = "score double, bucket long, shard int, n long, lang string"
    rows = [(i, t, 0.5, 1, 2, 3, "en") for i, t in ODD]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")


def components(ids, pairs):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_bpe_is_the_library(spark, odd):
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    rng = random.Random(1)
    parts = ["a", "aa", "x", " ", "  ", "\n", "é", "=", "==", "don't", "0", "日本"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(500)] + [t for _, t in ODD]
    made = bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [library.encode_ordinary(t or "") for t in texts]
    for row in bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).select("text", "bpe.*").collect():
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
    ids = bpe.encode(odd, RANKS, public_tokenizers.PATTERN).select("text", "bpe.ids")
    assert all(r["b"].decode() == (r["text"] or "") for r in bpe.decode(ids, RANKS).select("text", F.col("decoded.bytes").alias("b")).collect())


def test_packing(spark, odd):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(odd, WORDS).collect()
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 4096
    expected = Counter()
    for i, text in ODD:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected


def test_sum_of_squares_packs_tightly():
    drawn = np.random.default_rng(2).lognormal(6.5, 1.2, 4000).astype(int) + 1  # as documents: many short, few long
    lengths = np.sort(np.minimum(drawn, 4096))[::-1]
    number, offset = packing.sum_of_squares(lengths, 4096)
    assert np.bincount(number, lengths).max() <= 4096
    assert number.max() + 1 <= 1.02 * lengths.sum() / 4096


def test_line_index_is_reversible(spark):
    docs = spark.createDataFrame([(i, f"Shared line\n own {i}\n shared LINE ") for i in range(12)] + [(99, None)], SCHEMA)
    first, rest = docs.filter("doc_id < 6"), docs.filter("doc_id >= 6")
    index = lines.insert(lines.build(first, shard_keys=3), rest)

    def kept(index, docs, **more):
        return sorted(map(tuple, lines.drop_shared(index, docs, **more).select("doc_id", "lines.*").collect()), key=repr)

    whole = kept(lines.build(docs), docs)
    assert whole == kept(index, docs) == kept(index, docs, send=-1)
    assert (3, " own 3", 3, 2) in whole and (99, "", 1, 0) in whole
    assert all(n == 0 for *_, n in kept(lines.delete(index, rest), first))
    with pytest.raises(ValueError):
        lines.delete(lines.build(first), docs)


def test_cuckoo_filter():
    a, b = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, (2, 5000))
    table = lines.CuckooFilter.of(a, b)
    assert table.contains(a, b).all()
    table.delete(a[:2500], b[:2500])
    assert table.contains(a[2500:], b[2500:]).all() and table.contains(a[:2500], b[:2500]).mean() < 0.01


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, odd, words):
    rng = random.Random(4)
    texts = {}
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(60)]
        for copy in range(25):
            text = [w if rng.random() > 0.02 * (copy % 4) else f"v{rng.randrange(400)}" for w in base]
            texts[100 + 25 * family + copy] = " ".join(text)
    texts.update({i: t for i, t in ODD if i is not None})
    docs = spark.createDataFrame([*texts.items(), (7, "same text here")], SCHEMA)
    sets = {}
    for i, t in texts.items():
        w = [x.encode().lower().decode() for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    near = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    expected = components(sets, near)
    for r in minmax.near_duplicates(docs, words).collect():
        assert r["component_id"] == expected[r["doc_id"]] and r["n_shingles"] == len(sets[r["doc_id"]])
    assert minmax.near_duplicates(odd, words).filter("doc_id IS NULL").first()["kept"]


def test_entries_of_bands_are_dealt_once(spark, monkeypatch):
    rows = [(b, r, 10 * r) for b, held in {1: [5, 3, 9], 2: [4], 3: [8, 2], 4: [7]}.items() for r in held]
    members = minmax._members(spark.createDataFrame(rows, "bucket long, rep long, n long"))
    assert members._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    expected = [(1, 3, 30, 3, 30, 3), (1, 5, 50, 3, 30, 3), (1, 9, 90, 3, 30, 3), (3, 2, 20, 2, 20, 2), (3, 8, 80, 2, 20, 2)]
    assert sorted(map(tuple, members.collect())) == expected

    written, cut = [], minmax.cut
    monkeypatch.setattr(minmax, "cut", lambda df, *more: written.append(df.columns) or cut(df, *more))
    same, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = spark.createDataFrame([(1, same), (2, same), (3, same + " more"), (4, same + " most"), (5, other)], SCHEMA)
    found = {r["doc_id"]: r["component_id"] for r in minmax.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}
    assert sum("bands" in columns for columns in written) == 1  # the signatures, the widest rows, are written once


def test_one_row_of_each_group_stays(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    near_b = b + " more"
    rows = [(9, near_b), (7, a), (7, b), (3, a), (5, "own text"), (5, "own text"), (None, a), (None, a), (6, None), (6, None)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n long")
    kept = minmax.one_of_each(docs.repartition(3)).select("doc_id", "text").collect()
    expected = [(3, a), (7, b), (5, "own text"), (None, a), (None, a), (6, None), (6, None)]
    assert Counter(map(tuple, kept)) == Counter(expected)


def test_embedding_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    vectors = np.repeat(base, 8, 0) + rng.normal(scale=0.06, size=(320, 16))
    vectors[8:16] = vectors[8]
    labels = [None if i % 50 == 0 else i // 160 for i in range(320)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(zip(vectors, labels))]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [], 1), (404, [1.0, None], 1), (405, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    pairs = [(i, j) for i in range(320) for j in range(i) if labels[i] is not None and labels[i] == labels[j] and unit[i] @ unit[j] >= 0.98]
    degree, expected = Counter(x for p in pairs for x in p), components(range(320), pairs)
    found = {r["vec_id"]: r for r in polytope.links(df, block=7).collect()}
    assert sum(r["n_links"] for r in found.values()) >= 0.97 * 2 * len(pairs)
    assert all(found[i]["n_links"] <= degree[i] for i in range(320))
    assert np.mean([found[i]["component_id"] == expected[i] for i in range(320)]) >= 0.97
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in range(400, 406))


def test_search_is_exact(spark):
    rng = np.random.default_rng(6)
    vectors = np.round(rng.normal(size=(300, 8)), 2)  # rounding makes ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(500, None), (600, [float("inf")] * 8), (700, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = np.floor(1024 * vectors).astype(int)
    expected = []
    for q in range(0, 300, 100):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(300) if i != q)[:10]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    found = vafile.nearest(df, F.col("vec_id") % 100 == 0, block_vectors=50, block_queries=2)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_search_counts_rows_of_repeated_ids(spark):
    rng = np.random.default_rng(11)
    ids = [i % 40 for i in range(120)] + [7, 7]
    whole = rng.integers(-50, 50, (122, 4))
    whole[121] = whole[120]
    df = spark.createDataFrame(
        [(i, [float(x) / 1024 for x in v]) for i, v in zip(ids, whole)], "vec_id long, embedding array<double>")
    expected = []
    for q in (0, 7, 14, 21, 28, 35):
        scores = [(-int(whole[a] @ whole[b]), ids[b]) for a in range(122) for b in range(122) if ids[a] == q != ids[b]]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:10])]
    found = vafile.nearest(df, F.col("vec_id") % 7 == 0, block_vectors=30, block_queries=5)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_sharding(spark, odd):
    rows = sharding.shuffle_into_shards(spark.range(1003).withColumnRenamed("id", "doc_id"), 7, bucket=20).collect()
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(7)}
    assert all(slots[s] == list(range(1003 // 7 + (s < 1003 % 7))) for s in slots)
    assert len({r["doc_id"] for r in rows}) == 1003
    made = sharding.shard_documents(odd).collect()
    assert len(made) == len(ODD) and {r["size"] for r in made if r["doc_id"] in (1, 2)} == {16}


def test_communication_matrix():
    rng = np.random.default_rng(1)
    drawn = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(drawn) - 6) < 0.15 and abs(np.var(drawn) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    matrix = np.array(sharding.communication_matrix([10, 0, 25], [18, 17], 0))
    assert matrix.sum(1).tolist() == [10, 0, 25] and matrix.sum(0).tolist() == [18, 17]


def test_pages(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a>Menu</a></nav><div class='cookie-notice'>We use cookies, many.</div>"
        "<article><h1>Head</h1><p>One &amp; two,\n three.<p><b>Four<br>five</p><form>Ask. Me.</form><div id=comments><p>No, I.</p></div>"
        "<script>var a='</p>';</script></article><footer>Foot, foot.</footer>"
    )
    assert pages.main_text(page) == "Head\n\nOne & two, three.\n\nFour five"
    plain = "<body><div><p>Long enough, this one.</p><p>And another, as long.</p></div><div class=sidebar>Side, side.</div></body>"
    assert pages.main_text(plain) == "Long enough, this one.\n\nAnd another, as long."
    assert [pages.main_text(x) for x in (None, "", "<p>", "<!-- x", "<b")] == ["", "", "", "", "<b"]


def test_pages_without_one_article():
    first, second = "One, two. " * 30, "Three, four. " * 8
    uneven = f"<body><div id=content><h1>Head</h1><p>{first}</p><p>{second}</p></div></body>"
    assert pages.main_text(uneven) == f"Head\n\n{first.strip()}\n\n{second.strip()}"
    alone = f"<body><div><h1>Head</h1><ul><li>Short</li><li>{first}</li></ul><blockquote><p>{first}</p></blockquote></div></body>"
    assert pages.main_text(alone) == f"Head\n\nShort\n\n{first.strip()}\n\n{first.strip()}"
    sections = f"<body><div><section><p>{first}</p><p>{first}</p></section><section><p>{second}</p></section></div></body>"
    assert pages.main_text(sections) == f"{first.strip()}\n\n{first.strip()}\n\n{second.strip()}"
    articles = f"<body><article><p>{first}</p></article><article><p>{second}</p></article></body>"
    assert pages.main_text(articles) == f"{first.strip()}\n\n{second.strip()}"
    teaser = f"<body><div><p>{first}</p><p>{first}</p><p>{first}</p></div><article><p>{second}</p></article></body>"
    assert first.strip() in pages.main_text(teaser)
    links = "<div>" + "<div><a>Link</a></div>" * 5 + "</div>"
    assert pages.main_text(f"<body>{links}<div><p>{first}</p><p>{second}</p></div></body>") == f"{first.strip()}\n\n{second.strip()}"


@pytest.mark.parametrize("mark", ["class='site-content no-sidebar'", "class=has-sidebar", "id=with-comments", "class='layout-menu-left'"])
def test_pages_in_a_marked_wrapper(mark):
    text, other = "One, two. " * 30, "Three, four. " * 40
    parts = f"<div class=sidebar><p>{text}</p></div><div id=comments><p>{other}</p></div><form>Ask, me.</form>"
    article = f"<article><h1>Head</h1><p>{text}</p></article>"
    for inside in (article, article.replace("article", "main"), article.replace("article", "section")):
        assert pages.main_text(f"<body><div {mark}>{inside}{parts}</div></body>") == f"Head\n\n{text.strip()}"
        assert pages.main_text(f"<body><div {mark}>{inside}</div>{parts}</body>") == f"Head\n\n{text.strip()}"
        assert pages.main_text(f"<body><form><div {mark}>{inside}{parts}</div></form></body>") == f"Head\n\n{text.strip()}"
        assert pages.main_text(f"<body>{inside}<div {mark}>No, no.</div>{parts}</body>") == f"Head\n\n{text.strip()}"


def test_pages_with_many_comments():
    text, other = "One, two. " * 30, "Three, four. " * 40
    comments = "<div id=comments>" + f"<article><p>{other}</p></article>" * 30 + "</div>"
    for inside in ("<article><p>Short.</p></article>", f"<div><p>{text}</p><p>{text}</p></div>"):
        alone = pages.main_text(f"<body>{inside}</body>")
        assert alone and pages.main_text(f"<body>{inside}{comments}</body>") == alone
        assert pages.main_text(f"<body><div class=has-sidebar>{inside}{comments}</div></body>") == alone


def test_language_and_toxicity(spark, odd):
    rng = random.Random(7)
    words = {"aa": ["lona", "mira", "tola"], "bb": ["krix", "vrex", "strug"]}
    rows, labels = [], []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        toxic = int(i % 5 == 1)
        text = " ".join(rng.choices(words[lang], k=30)) + (" blargh" if toxic else "")
        rows.append((i, text, lang))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn(docs, ~language.held_out())
    found = {r["doc_id"]: r for r in language.predict(docs, profiles).select("doc_id", "language.*").collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows)
    unknown = {r["doc_id"] for r in language.predict(odd, profiles).filter("language.lang_pred = 'und'").collect()}
    assert unknown == {1, 2, 3, 4, 8}
    machine = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ~toxicity.held_out())
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, machine).select("doc_id", "toxicity.*").collect()}
    assert got == dict(labels)
    none = toxicity.learn(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"), ~toxicity.held_out())
    assert {r["p"] for r in toxicity.score(odd, none).select(F.col("toxicity.predicted").alias("p")).collect()} == {0}


def test_only_known_languages_stay(spark):
    rng = random.Random(9)
    words = {"aa": ["lona", "mira", "tola"], "bb": ["krix", "vrex", "strug"]}
    rows = [(i, " ".join(rng.choices(words["aa" if i % 2 else "bb"], k=60)), "aa" if i % 2 else "bb") for i in range(60)]
    foreign = " ".join("".join(rng.choices("абвгдежзиклмнопрстуфхцчшщыэюя", k=6)) for _ in range(100))
    rows += [(100, foreign, None), (101, foreign[:40], None), (102, None, "aa"), (103, "1 2 3", "bb"), (104, "lona", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stay = {*range(60), 101, 104}
    assert {r["doc_id"] for r in language.known_language(docs).collect()} == stay
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in language.known_language(unlabelled).collect()} == stay | {100}


def test_factorization_learns_pairs():
    rng = np.random.default_rng(8)
    rows = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(3000)]
    both = np.array([float({0, 1} <= set(r.tolist())) for r in rows])
    machine = toxicity.fit(np.arange(4), rows, both)
    assert ((machine.scores(rows) >= 0.5) == both).mean() > 0.99


def test_empty_tables(spark, odd):
    none = odd.limit(0).select("doc_id", "text")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for df in (
        bpe.round_trip(none, RANKS, public_tokenizers.PATTERN), packing.pack_documents(none, WORDS),
        lines.drop_shared(lines.build(none), none), minmax.near_duplicates(none), sharding.shard_documents(none),
        polytope.links(vectors), vafile.nearest(vectors, F.col("vec_id") % 100 == 0), pages.extract(none, "text"),
    ):
        assert df.count() == 0


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, TABLES)
        assert made.columns == columns, name
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert packed.select("doc_id").distinct().count() == before
    assert sorted(map(tuple, corpus_pipeline.run(spark, TABLES).select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect()))


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    from compare import connect, differences

    assert differences(spark, connect(TABLES), queries.QUERIES[name], queries.ORACLES[name], TABLES) == []


def _words(text):
    return [x.encode().lower().decode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def _one_of_each(texts, words):
    """Component of each id, by all pairs."""
    sets = {}
    for i, t in texts.items():
        w = _words(t)
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    near = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return components(sets, near)


def _pieces(texts):
    """Pieces of each document as the tokenizer itself makes them."""
    tokenizer, made = Tokenizer.from_file(WORDS), Counter()
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            made[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    return made


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_pipeline_stages_against_plain_python(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    foreign = "жить ещё шумно " * 40
    odd = {10**9: None, 10**9 + 1: "", 10**9 + 2: "1 2 3 ==", 10**9 + 3: foreign}
    schema = "doc_id long, text string, lang string"
    added = spark.createDataFrame([(i, t, None) for i, t in odd.items()], schema)
    docs = docs.unionByName(added.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)), allowMissingColumns=True)

    def through(name):
        stages[name](spark, docs, TABLES).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    before = _texts(docs)
    docs = through("language_id")
    assert _texts(docs) == {i: t for i, t in before.items() if i not in odd}

    before = _texts(docs)  # too few toxic rows to learn from here: next test
    clean = {r["doc_id"] for r in spark.read.parquet(f"{TABLES}/labels.parquet").filter("toxic = 0").collect()}
    docs = through("toxicity")
    after = _texts(docs)
    assert all(before[i] == t for i, t in after.items())
    assert not (before.keys() - after.keys()) & clean

    before = _texts(docs)
    blank = " \t\n\x0b\x0c\r"
    key = {i: [x.strip(blank).encode().lower().decode() for x in (t or "").split("\n")] for i, t in before.items()}
    held = Counter(k for keys in key.values() for k in set(keys))
    docs = through("line_dedup")
    expected = {
        i: "\n".join(x for x, k in zip((t or "").split("\n"), key[i]) if not k or held[k] < 10) for i, t in before.items()
    }
    assert _texts(docs) == expected
    assert docs.filter("n_chars <> length(text)").isEmpty()

    component = _one_of_each(expected, 5)
    docs = through("near_dedup")
    before = {i: t for i, t in expected.items() if component[i] == i}
    assert _texts(docs) == before

    packed = stages["packing"](spark, docs, TABLES).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == _pieces(before)


def test_toxicity_stage_drops_the_toxic_rows(spark, tmp_path):
    rng = random.Random(12)
    toxic = {i: i % 5 == 1 for i in range(400)}
    rows = [(i, " ".join(rng.choices(["lona", "mira", "tola", "krix"], k=30)) + " blargh" * t) for i, t in toxic.items()]
    labels = spark.createDataFrame([(i, int(t)) for i, t in toxic.items() if i < 300], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert sorted(map(tuple, kept.collect())) == [(i, t) for i, t in rows if not toxic[i]]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_queries_against_plain_python(spark):
    texts = _texts(spark.read.parquet(f"{TABLES}/documents.parquet"))
    made = queries.QUERIES["op2_packing"](spark, TABLES).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in made) == _pieces(texts)
    found = queries.QUERIES["op5_minmax"](spark, TABLES).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == _one_of_each(texts, 2)
    made = queries.QUERIES["op1_bpe"](spark, TABLES).select("doc_id", "decoded_sha256").collect()
    assert dict(map(tuple, made)) == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()}
    found = queries.QUERIES["op10_language"](spark, TABLES).filter("held_out").collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in found) >= 0.98 * len(found)
