"""Exact substring dedup against a table of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import queries, suffixes

SCHEMA = "doc_id long, text string, start string, id int, kept int"
NAMES = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(texts, length=suffixes.LENGTH):
    """(n_bytes, n_removed, n_spans, sha) of texts in their order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        rest = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def results(rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in rows}


def odd_texts():
    rng = random.Random(2)
    letters = lambda n, some="abcdefgh ": "".join(rng.choices(some, k=n))
    passages = [letters(n) for n in (99, 100, 101, 150, 400)]
    texts = [None, "", " ", "a" * 99, "a" * 100, "a" * 101, "a" * 500, "ab" * 200, "abc" * 80 + letters(60), "\0" * 150, "\0" * 120]
    for i in range(120):
        text = "".join(rng.choice([rng.choice(passages), letters(rng.randint(0, 120)), letters(30, "é中")]) for _ in range(rng.randint(1, 5)))
        for _ in range(rng.randint(0, 3)):  # an edit
            p = rng.randrange(len(text) + 1)
            text = text[:p] + rng.choice(["", "X", "yy"]) + text[p + rng.randint(0, 2) :]
        texts.append(text)
        if i % 3 == 0:
            base = rng.choice(texts[11:])
            p = rng.randrange(len(base) + 1)
            texts.append(base if i % 2 else base[:p] + "Q" + base[p:])
    return texts


@pytest.mark.parametrize("held", [suffixes.HELD_NAMES, 0])
def test_every_repeat_against_brute_force(spark, held):
    texts = odd_texts()
    table = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    got = results(suffixes.without_repeats(table, held_names=held).collect())
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_slices_of_a_long_text_and_full_tasks(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefg", k=6)) for _ in range(300)]
    long = " ".join(rng.choices(words, k=9000))
    texts = [long[:300], long, long[5000:9000], "x" * 3000]
    monkeypatch.setattr(suffixes, "SLICE", 1500)
    monkeypatch.setattr(suffixes, "PLACES_SENT", 200)
    monkeypatch.setattr(suffixes, "NAMES_SENT", 500)
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(4)), "tie": pa.array([0] * 4), "text": pa.array(texts)})
    whole = pa.Table.from_batches(suffixes._sender(3, None)([batch]))
    spans = {i: np.zeros(len(t), bool) for i, t in enumerate(texts)}
    for b in range(3):
        mine = whole.filter(pa.array(whole["bucket"].to_numpy() == b))
        if mine.num_rows:
            for r in suffixes._find(mine).to_pylist():
                spans[r["id"]][r["start"] : r["end"]] = True
    want = brute(texts)
    assert [int(spans[i].sum()) for i in range(4)] == [w[1] for w in want]


def test_order_of_rows(spark):
    text = "some words that stand here more than once, some words that stand here more than once, again and again " * 2
    rows = [(None, text), (None, text), (5, text), (5, text), (4, text + "!")]
    out = suffixes.without_repeats(spark.createDataFrame([(*r, "", 0, 0) for r in rows], SCHEMA), kept=True).collect()
    assert len(out) == 5 and sum(r.n_removed == r.n_bytes for r in out) == 3
    [first] = [r for r in out if r.doc_id is None and r.n_removed < r.n_bytes]
    assert (len(text), first.n_removed, len(first.spans), first.kept_sha256) == brute([text])[0]
    [last] = [r for r in out if r.doc_id == 4]
    assert bytes(last.kept) == b"!" and [tuple(s) for s in last.spans] == [(0, len(text))]


def test_no_rows(spark):
    assert suffixes.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    short = suffixes.without_repeats(spark.createDataFrame([(1, None, "", 0, 0), (2, "x" * 99, "", 0, 0)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in short) == [(1, 0, 0), (2, 99, 0)]


def test_query_against_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: tuple(r[n] for n in NAMES) for r in queries.op11_suffixes(spark, sf).collect()}
    assert rows == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs]), strict=True))
