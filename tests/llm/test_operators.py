"""The operators on small, odd tables, against brute force, exact round trips and held-out rows."""

import io
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import common, decontaminate, jaccard, language, mixing, neighbours, passages, sharding, stages, tokens, toxicity, warc
from parley.llm import components as ties
from parley.llm.common import written
from parley.llm.components import components

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
TEXTS = [None, "", " \t", "one", "one two", LONG, "the same text for two rows " * 4, "the same text for two rows " * 4, "Ünïcödé\x1cwords, 中文", "<|endoftext|> x"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, size string, score string, hub int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, x, "en" if i % 3 else None, "s" if i % 2 else None, None, "x", "y", 1) for i, x in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[6]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding_moves_rows_into_the_new_shard_only(spark, docs, empty):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.assign_shards(many).toPandas()
    assert set(rows.grown_shard[rows.grown_shard != rows["shard"]]) == {8}
    for _, group in rows.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group))) and 350 < len(group) < 650
    odd = sharding.assign_shards(docs).toPandas()
    assert len(odd) == len(TEXTS) + 1 and odd["size"].min() == 1
    assert sharding.assign_shards(empty).count() == 0


def test_mix_meets_targets(docs, empty):
    rows = mixing.mix(mixing.measured(docs)).toPandas()
    assert len(rows) == len(TEXTS) + 1 and (rows.taken <= 2 * rows["size"]).all()
    for _, group in rows.groupby("source_size"):
        assert abs(group.taken.sum() - group.target.iloc[0]) <= 1
    assert mixing.mix(mixing.measured(empty)).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_tokens_round_trip(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    rows = tokens.token_table(docs).orderBy("start").toPandas()
    assert rows.start.tolist() == [0, *np.cumsum(rows.n_tokens)[:-1]]
    want = sorted(zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for t in [*TEXTS, TEXTS[6]])
    assert sorted(rows.ids_crc32) == want
    assert tokens.token_table(empty).count() == 0
    for n, top in itertools.product((0, 1, 1023, 1024, 1025, 5000), (1, 50_000, 2**32)):
        ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint32)
        blocks = tokens.pack_blocks(ids)
        back = [tokens.unpack_block(b)[0] for b in blocks]
        assert (np.concatenate([np.zeros(0, np.uint32), *back]) == ids).all()


def test_warc_round_trip(spark):
    rows = [(1, "u", "a"), (2, None, "a"), (3, "u\r\nX: y", None), (4, "u", "é" * 300_000), (2, None, "a"), (None, "u", "a")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.archived(pages, payloads=True).toPandas()
    assert len(out) == 6 and sorted(out.record_type) == ["response"] * 3 + ["revisit"] * 3
    assert set(out.refers_to.dropna()) == {1} and out.payload_bytes.max() == 600_000
    assert warc.archived(pages.limit(0)).count() == 0
    good = warc.record(1, "u", b"abc", warc.payload_digest(b"abc"), None, False)
    assert len(list(warc.records(io.BytesIO(good * 3)))) == 3
    for bad in (good[:-3], b"x" + good, warc.record(1, "u", b"abc", warc.payload_digest(b"abd"), None, False)):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad)))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(20):
        first = np.concatenate(([0], np.cumsum(rng.integers(0, 7, 5))))
        scores = (4 * rng.normal(size=(first[-1], 3))).astype(np.float32)
        labels = language.viterbi(scores, first, 3.0)
        for a, b in itertools.pairwise(first):
            value = lambda p, a=a: sum(scores[a + i, x] for i, x in enumerate(p)) - 3 * sum(x != y for x, y in itertools.pairwise(p))
            if a < b:
                assert abs(value(labels[a:b]) - max(map(value, itertools.product(range(3), repeat=b - a)))) < 1e-3


def test_language_of_held_out_rows(spark, docs, empty):
    words = {"en": "the of and with", "ru": "и в не на", "fr": "le la des avec"}
    rows = [(i, " ".join(np.random.default_rng(i).choice(w.split(), 9)), lang) for i in range(60) for lang, w in words.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table.filter("doc_id < 40"))
    out = language.identify(table.filter("doc_id >= 40"), model).toPandas()
    assert (out.lang == out.lang_pred).all() and out.score.between(0, 1).all()
    both = spark.createDataFrame([("the of and with the of " * 5 + "и в не на и в " * 5,)], "text string")
    assert [s.lang for s in language.identify(both, model).first().spans] == ["en", "ru"]
    odd = language.identify(docs, model).toPandas()
    assert odd[odd.text.isna() | (odd.text.str.strip() == "")].lang_pred.eq("und").all()
    assert set(language.identify(docs, language.fit(empty)).toPandas().lang_pred) == {"und"}


def test_marks_alone_are_no_word(spark):
    known = spark.createDataFrame([("en", "the of and with")] * 5, "lang string, text string")
    texts = ["\u0301", "123 \u0301", "a\u0301", "\u0301a", "\u0301 \u0302 b", "1 2"]
    out = language.identify(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), language.fit(known)).orderBy("i").collect()
    assert [r.lang_pred for r in out] == ["und", "und", "en", "en", "en", "und"]


def test_short_vectors_are_ranked_by_their_score(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(400, 8)) * 10.0 ** rng.integers(-9, -4, 400)[:, None]
    points[300:320] = points[7]  # ties go to the smaller id
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, table.filter("vec_id % 40 = 0"), 10).collect()
    for q in range(0, 400, 40):
        exact = [(points[q] * p).sum() for p in points]
        want = sorted((i for i in range(400) if i != q), key=lambda i: (-exact[i], i))[:10]
        assert [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == want


def test_every_language_is_learned(spark):
    word = lambda i: "".join(chr(97 + (i // 26**k + 7 * k) % 26) * 3 for k in range(3))
    rows = [(f"l{i}", f"{word(i)} " * 6) for i in range(300)]
    table = spark.createDataFrame(rows, "lang string, text string")
    out = language.identify(table, language.fit(table)).collect()
    assert len({r.lang_pred for r in out}) == 300 and all(r.lang == r.lang_pred for r in out)
    many = spark.range(language.MAX_LANGUAGES + 1).select(F.lit("a b").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        language.fit(many)


def brute_components(texts, words, percent):
    sets = [jaccard.grams((t or "").encode(), words) for t in texts]
    root = list(range(len(sets)))
    for _ in sets:
        for i, j in itertools.combinations(range(len(sets)), 2):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[i] = root[j] = min(root[i], root[j])
    return root


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_against_brute_force(spark, words, percent):
    rng = np.random.default_rng(1)
    texts = [None, "", "a", "a", "A b"]
    for _ in range(12):
        base = [f"v{x}" for x in rng.integers(0, 500, rng.integers(8, 120))]
        for _ in range(4):
            base = [*base]
            base[rng.integers(len(base))] = f"n{rng.integers(1000)}"
            texts.append(" ".join(base))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = jaccard.linked(table, words, percent).orderBy("doc_id").toPandas()
    assert out.component_id.tolist() == brute_components(texts, words, percent)
    assert jaccard.linked(table.limit(0), words, percent).count() == 0


def test_jaccard_join_of_odd_rows(docs):
    assert jaccard.linked(docs).count() == len(TEXTS) + 1
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and kept.filter("text LIKE 'the same%'").count() == 1


def test_one_of_each_keeps_unrelated_documents_without_or_with_equal_ids(spark):
    text = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (7, text("d")), (7, text("e")), (None, text("a") + " z"), (8, text("d") + " z"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text or "") for r in jaccard.one_of_each(table).collect())
    assert len(kept) == 6 and [x for x in kept if x[0]] == [(7, text("d")), (7, text("e"))]
    assert [x[1] for x in kept if x[1].startswith(("b", "c"))] == [text("b"), text("c")]
    apart = spark.createDataFrame(rows[:5], "doc_id long, text string")
    assert jaccard.one_of_each(apart).count() == 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101)]
    out = components(spark.createDataFrame(edges, "a long, b long")).toPandas()
    assert dict(zip(out.id, out.component, strict=True)) == {**dict.fromkeys(range(51), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_decontamination_in_blocks(spark, docs):
    items = [(1, "alpha beta gamma"), (2, " ".join(f"k{i}" for i in range(14))), (3, None), (None, "zeta"), (1, "alpha beta gamma")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["ALPHA, beta-gamma! tail", "x " + " ".join(f"k{i}" for i in range(2, 13)) + " y", "beta gamma", "Zeta", None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (10, 8_000_000):
        out = decontaminate.contamination(decontaminate.find_passages(table, bench, block_bytes=block)).orderBy("doc_id").toPandas()
        assert out.n_hit.tolist() == [3, 11, 0, 1, 0, 0] and out.n_items.tolist() == [1, 1, 0, 1, 0, 0]
    left = decontaminate.without_passages(decontaminate.find_passages(table, bench)).orderBy("doc_id").toPandas()
    assert left.text.fillna("").str.strip().tolist()[:2] == ["! tail", "x  y"] and 3 not in set(left.doc_id)
    assert decontaminate.find_passages(docs, bench.limit(0)).count() == len(TEXTS) + 1


def test_passages(spark, docs):
    passage = " ".join(f"p{i}" + ("." if i % 6 == 5 else "") for i in range(72))
    fill = lambda s: " ".join(f"{s}{i}" for i in range(60))
    texts = [fill("a") + "\n" + passage + "\n" + fill("b"), fill("c") + "\n" + passage, fill("d"), None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = passages.repeats(table).orderBy("doc_id").toPandas()
    assert out.doc_id.tolist() == [0, 1] and out.removed.tolist() == [False, True]
    assert (out["last"] - out["first"]).tolist() == [72, 72]
    assert passages.repeats(docs.limit(0)).count() == 0


def test_passages_inside_lines_against_brute_force(spark):
    rng = np.random.default_rng(4)
    fresh = itertools.count()
    fill = lambda n: [f"f{next(fresh)}" for _ in range(n)]
    texts = [fill(int(n)) for n in rng.integers(20, 90, 14)]
    for size in (29, 30, 31, 51, 55, 71, 120):
        passage = fill(size)
        for i in rng.choice(14, 3, replace=False):
            at = int(rng.integers(len(texts[i]) + 1))
            texts[i][at:at] = passage
    seen = {}
    for i, words in enumerate(texts):
        for j in range(len(words) - 29):
            seen.setdefault(tuple(words[j : j + 30]), set()).add(i)
    want, gone = set(), set()
    for i, words in enumerate(texts):
        for j in range(len(words) - 29):
            rows = seen[tuple(words[j : j + 30])]
            if len(rows) > 1:
                want |= {(i, x) for x in range(j, j + 30)}
                gone |= {(i, x) for x in range(j, j + 30)} if min(rows) < i else set()
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    out = passages.repeats(table).collect()
    assert {(r.doc_id, x) for r in out for x in range(r["first"], r["last"])} == want
    assert {(r.doc_id, x) for r in out if r.removed for x in range(r["first"], r["last"])} == gone and gone


def test_short_gap_bridges_paragraphs():
    spans = passages.spans_of([(0, 28, 1, False), (31, 24, 2, False)], np.zeros(0, np.int64))
    assert [s[:2] for s in spans] == [(0, 28), (31, 55)]
    assert passages.spans_of([(0, 28, 1, False), (40, 24, 2, False)], np.zeros(0, np.int64)) == []


def test_what_first_occurs_here_does_not_keep_the_repeats_beside_it():
    spans = passages.spans_of([(0, 20, 1, False), (20, 20, 2, True), (40, 20, 3, False)], np.zeros(0, np.int64))
    assert [(a, b, removed) for a, b, _, removed in spans] == [(0, 20, True), (20, 40, False), (40, 60, True)]


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(900)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0, None] * 4), (None, [1.0] * 8), (1004, [1.0]), rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = neighbours.nearest(table, table.filter("vec_id % 20 = 0"), 20).toPandas()
    x = np.array([r[1] for r in rows[:900]], np.float32).astype(float)
    hits = sum(len(set(np.argsort(-np.where(np.arange(900) == q, -9e9, x @ x[q]))[:20]) & set(g.vec_id)) for q, g in out.groupby("query_id"))
    assert out.groupby("query_id").size().eq(20).all() and hits >= 0.9 * 20 * 45
    few = table.filter("vec_id < 5")
    assert neighbours.nearest(few, few, 20).count() == 20
    assert neighbours.nearest(table.limit(0), table).count() == 0


def test_search_ends_with_the_distance_ratio():
    x = np.random.default_rng(5).normal(size=(400, 16))
    index = neighbours.Index(9.0, x, *neighbours._graph(x), np.arange(0, 400, 20), ratio=1.45)
    points = np.random.default_rng(6).normal(size=(8, 16))
    for p, far in zip(points, index.search(points), strict=True):
        want = np.sqrt(((x - p) ** 2).sum(axis=1))
        assert set(np.flatnonzero(want <= want.min() * index.ratio)) <= set(np.flatnonzero(far <= far.min() * index.ratio + 1e-9))


def test_many_lists_are_pruned_and_repeated_rows_count_once(spark):
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(60, 24))
    x = middle[rng.integers(0, 60, 6000)] + 0.4 * rng.normal(size=(6000, 24))
    table = spark.createDataFrame([(i, p.tolist(), "a") for i, p in enumerate(x)], "vec_id long, embedding array<double>, list string")
    rows = neighbours.usable(table)
    index = neighbours.fit(rows, 10, lists=300)
    queries = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    reads = neighbours.probes(queries, index, np.full(300, 20), 10)
    assert reads.count() < 60 * 300 / 4
    twice = table.unionAll(table.filter("vec_id < 500")).unionAll(table.filter("vec_id < 500"))
    out = neighbours.nearest(twice, twice.filter("vec_id % 100 = 0"), 10).toPandas()
    assert not out.duplicated(["query_id", "vec_id"]).any() and out.groupby("query_id").size().eq(10).all()
    hits = sum(len(set(np.argsort(-np.where(np.arange(6000) == q, -np.inf, x @ x[q]))[:10]) & set(g.vec_id)) for q, g in out.groupby("query_id"))
    assert hits >= 0.9 * 600


def test_toxicity_of_held_out_rows(spark, docs):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        words = [f"t{x}" for x in rng.integers(0, 200, 30)]
        if i % 5 == 0:
            words[3] = ["vile", "scum", f"zork{rng.integers(99)}"][i // 5 % 3]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(table.drop("toxic"), table.filter("doc_id < 200").select("doc_id", "toxic"))
    out = toxicity.score(table.filter("doc_id >= 200"), model).toPandas()
    assert (out.toxic == out.predicted).mean() >= 0.97
    assert toxicity.score(docs, model).count() == len(TEXTS) + 1
    assert toxicity.score(docs, toxicity.fit(docs, table.limit(0).select("doc_id", "toxic"))).filter("predicted = 1").count() == 0


def test_language_stage_keeps_texts_if_nothing_is_learned(spark):
    rows = [(1, "the of and"), (2, "и в не"), (3, "123 ..."), (4, None), (5, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (table, table.withColumn("lang", F.lit(None).cast("string"))):
        out = stages.language(spark, docs, "")
        assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_output"]


def test_one_of_each_keeps_columns_of_any_name(spark):
    schema = "doc_id long, text string, row string, component string, __row long, __0 int"
    same = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, same, "r", "c", 7, 0), (2, same + " end", "r", "c", 7, 0), (3, None, "r", None, 7, 1), (3, None, "r", None, 7, 1), (None, "other words here", "q", "c", None, 2)]
    docs = spark.createDataFrame(rows, schema)
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(left.collect(), key=str) == sorted(docs.filter("doc_id = 1 OR doc_id IS NULL").unionAll(docs.filter("doc_id = 3").limit(1)).collect(), key=str)


def test_mix_takes_its_words_through_the_range_sorted_stream(spark, docs):
    rows = mixing.mix(mixing.measured(docs.unionAll(docs)))
    assert "training_order" in str(rows.inputFiles())
    found = rows.select("doc_id", "size", "taken", "target", "source", F.explode_outer("passes").alias("p")).collect()
    read = sorted((r.p for r in found if r.p), key=lambda p: (p.start, p.start + p.words))
    # the stream has no gaps: each pass starts where the one before it ends, in the order of positions
    assert [p.start for p in read] == [0, *np.cumsum([p.words for p in read])[:-1]]
    assert all(a.position <= b.position for a, b in itertools.pairwise(p for p in read if p.words))
    assert rows.agg(F.sum("taken")).first()[0] == sum(p.words for p in read) == sum(round(t) for t in {r.source: r.target for r in found}.values())
    assert rows.count() == 2 * docs.count()


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_one_of_few_signatures(percent):
    rng = np.random.default_rng(11)
    sets, links = [], []
    for i in range(600):
        size = int(rng.choice([1, 2, 3, 5, 8, 13, 24, 40, 90, 180, 400]) * rng.uniform(1, 1.6)) or 1
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        # as many differences as a link allows, split at random between what is left out and what is added
        out = int(rng.integers(0, (100 - percent) * size // 100 + 1))
        added = (100 * (size - out) - percent * size) // percent
        sets += [base, np.concatenate((base[out:], rng.integers(0, 2**63, added, dtype=np.uint64)))]
        if len(sets[-1]):
            links.append((2 * i, 2 * i + 1))
    sizes = np.array([len(s) for s in sets])
    bands = jaccard.Bands(percent, dict(zip(*(x.tolist() for x in np.unique(jaccard.Bands.of(np.maximum(sizes, 1), percent), return_counts=True)), strict=True)))
    doc, sig = bands.signatures(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), len(sets))
    of = {}
    for d, s in zip(doc.tolist(), sig.tolist(), strict=True):
        of.setdefault(d, set()).add(s)
    assert all(of[a] & of[b] for a, b in links) and len(links) > 500
    assert len(sig) < 0.6 * sizes.sum()


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {folders.apply(i).getName() for i in range(folders.size()) if folders.apply(i).getName().startswith("shuffle_")}

    before = files()
    table = written(spark.range(1000).groupBy((F.col("id") % 97).alias("k")).count(), "counts")
    assert not files() - before
    assert table.count() == 97 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_texts_are_encoded_together_as_the_tokenizer_does_alone():
    rng = np.random.default_rng(6)
    signs = [*" \t\n\r\x0b\x1c\x85\xa0     　ab1.'é中ж̀", "  ", " and", "'s", "<|endoftext|>", "ą", "ࠀ", "x" * 70]
    texts = [None, "", *("".join(signs[i] for i in rng.integers(0, len(signs), rng.integers(0, 15))) for _ in range(3000))]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for some in (texts, texts[:1], texts[:2], [], [" "], texts):
        ids, sizes = encoder.encode(pa.array(some, pa.string()))
        want = [encoder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in some]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_runs_of_many_short_parts_are_those_of_long_ones(monkeypatch):
    texts = [b"a b c d e f g", b"", b"x " * 9, b"one Two", b"a b c d e a b c d e a b c d e"] * 3
    words, found = common.Words(texts), []
    for longest in (0, 10**9):
        monkeypatch.setattr(common, "LONG_PART", longest)
        doc, h = words.shingles(5)
        assert (np.diff(doc) >= 0).all()
        found.append(sorted(zip(doc.tolist(), h.tolist(), strict=True)))
    assert found[0] == found[1]
    for i, t in enumerate(texts):
        assert sum(d == i for d, _ in found[0]) == len(jaccard.grams(t, 5))
    # what no later step reads is not made
    assert not passages.Paragraphs(texts, signed=False, sketched=False).sketch


def test_known_pieces_take_little_memory():
    import tracemalloc

    encoder = tokens.Encoder(tokens.default_tokenizer())
    texts = pa.array([" ".join(f"w{i}" for i in range(k, 100_000, 50)) for k in range(50)], pa.string())
    tracemalloc.start()
    encoder.encode(texts)
    held = tracemalloc.get_traced_memory()[0] + encoder.known.nbytes
    tracemalloc.stop()
    assert len(encoder.known) == 100_000 and held < 110 * len(encoder.known)


def test_written_tables_take_small_batches(spark, tmp_path):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    texts = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("0123456789"), 1000).alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    assert common.written(texts.mapInArrow(run, "n long"), "batches").agg(F.max("n")).first()[0] < 6_000_000
    assert spark.conf.get(key) == before


def test_passages_are_cut_without_a_second_python_step(spark):
    bench = spark.createDataFrame([("1", "alpha beta gamma")], "item_id string, text string")
    texts = ["\u00e9\u4e2d alpha beta gamma \u00e9 alpha beta gamma", "no hit \u00e9", None, "alpha beta gamma"]
    left = decontaminate.without_passages(decontaminate.find_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench))
    assert left.columns == ["doc_id", "text"]
    assert {r.doc_id: r.text for r in left.collect()} == {0: "\u00e9\u4e2d  \u00e9 ", 1: "no hit \u00e9", 2: None}
    assert left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_joined_starts_no_python_for_empty_tables(spark):
    members = spark.createDataFrame([(1, 1, 5, 0, 0, 0, 0)], "sig long, id long, n long, p0 long, p1 long, p2 long, p3 long")
    out = jaccard.joined(common.written(members, "members"), None, 80)
    assert out.columns == ["id", "component"] and out.count() == 0
    assert "ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()


def test_passages_leave_only_tables_that_are_read(spark, docs):
    folder, passage = set(), " ".join(f"p{i}" for i in range(40))
    table = spark.createDataFrame([(1, passage + " x\n" + passage), (2, "y " + passage), (3, "z")], "doc_id long, text string")
    kept = passages.written
    passages.written = lambda df, label: folder.add((label, out := kept(df, label))) or out
    try:
        spans = passages.repeats(table)
    finally:
        passages.written = kept
    assert {r.doc_id for r in spans.collect()} == {1, 2}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = {label for label, df in folder if any(p.getFileSystem(conf).exists(p) for p in map(path, df.inputFiles()))}
    assert there == {"paragraphs", "runs", "run-names"}


def test_groups_of_the_same_sets_are_joined_once(spark):
    rows = [(s, i) for s, ids in ((1, (5, 6, 7)), (2, (5, 6, 7)), (3, (5, 6)), (4, (6, 7)), (5, (6, 7)), (6, (9,))) for i in ids]
    left = jaccard.different(common.written(spark.createDataFrame(rows, "sig long, id long"), "rows"))
    assert sorted(left.collect()) == [(s, i) for s, i in rows if s in (1, 3, 4)]


def test_joined_compares_a_large_group_in_three_rounds(spark, monkeypatch):
    # in the group 1, sets are similar to the one of the next number but one; groups 2 and 3 hold all or some of them
    n, turns = 150, []
    rows = [(1, i, 50) for i in range(n)] + [(2, i, 50) for i in range(n)] + [(3, i, 50) for i in range(0, n, 3)]
    sketch = [F.lit(0).cast("long").alias(f"p{i}") for i in range(4)]
    members = common.written(spark.createDataFrame(rows, "sig long, id long, n long").select("*", *sketch), "members")

    def verify(pairs):
        turns.append(sorted(map(tuple, pairs.collect())))
        similar = F.when(F.col("b") - F.col("a") == 2, 50).otherwise(0).cast("long")
        return common.written(pairs.select("a", "b", similar.alias("common"), F.lit(50).cast("long").alias("total")), "verified")

    monkeypatch.setattr(jaccard, "HUBS", (1, 2))
    monkeypatch.setattr(jaccard, "BLOCK", 40, raising=False)
    found = jaccard.joined(members, verify, 80).collect()
    assert {r.id: r.component for r in found} == {i: i % 2 for i in range(n)}
    assert len(turns) == 3 and len({p for t in turns for p in t}) == sum(map(len, turns))


def test_sketches_of_long_texts_tell_them_apart(spark):
    rng = np.random.default_rng(11)
    doc, shingle = np.repeat(np.arange(3), 1500), rng.integers(0, 2**63, 4500, dtype=np.uint64)
    shingle[1500:2940] = shingle[:1440]  # the second is similar to the first, the third to none
    columns = ["n", *jaccard.SKETCH]
    of = [dict(zip(columns, (1500, *(int(x[i]) for x in jaccard.sketches(doc, shingle, 3))), strict=True)) for i in range(3)]
    rows = [(a, b, *of[a].values(), *of[b].values()) for a, b in ((0, 1), (0, 2), (1, 2))]
    pairs = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ("a", "b", *columns, *(f"hub_{c}" for c in columns))))
    left = pairs.filter(jaccard.may_link(80, jaccard.SKETCH)).select("a", "b").collect()
    assert list(map(tuple, left)) == [(0, 1)]


def test_few_edges_are_tied_without_rounds(spark, monkeypatch):
    rng = np.random.default_rng(12)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (250, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    table, tables, kept, found = spark.createDataFrame(edges, "a long, b long"), [], ties.written, []
    monkeypatch.setattr(ties, "written", lambda df, label: tables.append(label) or kept(df, label))
    for few in (500_000, 0):
        monkeypatch.setattr(ties, "FEW", few, raising=False)
        tables.clear()
        found.append((sorted(map(tuple, components(table).collect())), len(tables)))
    assert found[0][0] == found[1][0] and found[0][1] == 1 < found[1][1]


def test_runs_are_kept_by_the_first_text_also_without_or_with_equal_ids(spark):
    passage = " ".join(f"q{i}" for i in range(40))
    table = spark.createDataFrame([(None, passage), (7, "x " + passage), (7, "y " + passage), (9, passage)], "doc_id long, text string")
    named = jaccard.named(table).select("doc_id", "row", "text")
    want = named.orderBy(passages._order()).first()["row"]
    found = passages._equal_runs(named).collect()
    assert {r.row: {x % 2 for x in r.runs} for r in found} == {r.row: {int(r.row == want)} for r in named.collect()}
