"""Token alignment against a plain pass over both token lists."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from parley.llm import alignment, queries

SCHEMA = "doc_id long, text string, n_a string, links int, row int"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path_a, path_b = alignment.default_tokenizers()
    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    known = alignment.bytes_of_characters()

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(known[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ids_b]
        return ids_a, bytes_a, ids_b, bytes_b

    return tokens


def brute(texts, tokens):
    every, found = Counter(), []
    for text in texts:
        groups, links = [], []
        if text:
            ids_a, bytes_a, ids_b, bytes_b = tokens(text)
            whole = (" " + text).encode()
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
                i = j = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    m, n = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append(f"{','.join(map(str, ids_a[i:m]))}|{','.join(map(str, ids_b[j:n]))}")
                    links.append((ids_a[m - 1], ids_b[n - 1]))
                    i, j = m, n
                found.append((i, j, groups, links))
        if not groups:
            found.append((0, 0, [], []))
        every.update(links)
    best = {}
    for (_, b), n in every.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (i, j, len(g), len(l), sum(every[x] == best[x[1]] for x in l), sum(every[x] for x in l), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, j, g, l in found
    ]


def odd_texts():
    rng = random.Random(5)
    marks = ["the", " ", "  ", "\n", "\r", "\r\n", ";\r", "\t", "word", "überall", "中文", "\u3000", "\xa0", "\u2003", "\x1c", "1234"]
    marks += ["<|endoftext|>", "<s>", "'ll", "é", "\x85", "x.", "\U0001f642", "\x00", "\u2581"]
    texts = [None, "", " ", "  ", "a ", " a", "\n", "\ufeff", "a\u2581b", "\u2581", "plain words", "plain words", "<|endoftext|> <s></s><unk>"]
    texts += ["".join(rng.choices(marks[:-1] if i % 4 else marks, k=rng.randint(1, 12))) for i in range(400)]
    return [*texts, "x" * 5000 + " " + "y z " * 3000]


@pytest.mark.parametrize("held", [alignment.HELD_PAIRS, 0])
def test_alignment_against_brute_force(spark, tokenizers, held):
    texts = odd_texts()
    table = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = {r.doc_id: tuple(r[n] for n in NAMES) for r in alignment.with_corpus_counts(table, held_pairs=held).collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts, tokenizers)


def test_memory_may_be_emptied(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "LONGEST", 4)
    aligner = alignment.Aligner(*alignment.default_tokenizers())
    texts = odd_texts()
    for text, want in zip(texts, brute(texts, tokenizers), strict=True):
        [(groups, n_a, n_b, n_groups, codes)] = aligner.align([text])
        assert (n_a, n_b, n_groups, len(codes), hashlib.sha256(groups).hexdigest() if n_a else "") == (*want[:4], want[6])


def test_groups_hold_both_sides(spark, tokenizers):
    texts = ["überall 1234 words", None, "plain; 中文 words\n\nand more"]
    out = alignment.token_groups(spark.createDataFrame([(i, t, "", 0, 0) for i, t in enumerate(texts)], SCHEMA)).orderBy("doc_id", "number").collect()
    for i, text in enumerate(texts):
        mine = [r for r in out if r.doc_id == i]
        if not text:
            assert not mine
            continue
        ids_a, bytes_a, ids_b, bytes_b = tokenizers(text)
        assert sum((r.a_ids for r in mine), []) == ids_a and sum((r.b_ids for r in mine), []) == ids_b
        size = dict(zip(ids_a, map(len, bytes_a), strict=True)), dict(zip(ids_b, map(len, bytes_b), strict=True))
        assert all(sum(size[0][x] for x in r.a_ids) == sum(size[1][x] for x in r.b_ids) == r.end - r.start for r in mine)
        assert [r.start for r in mine] == [0, *[r.end for r in mine[:-1]]] and mine[-1].end == len(text.encode()) + 1


def test_coalescing_of_overlaps():
    a, b = alignment.coalesced(np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([0, 2, 5, 8]), np.array([2, 5, 8, 9]))
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1, 1]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.with_corpus_counts(empty).count() == 0 and alignment.token_groups(empty).count() == 0


def test_query_against_brute_force(spark, sf, tokenizers):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: tuple(r[n] for n in NAMES) for r in queries.op12_alignment(spark, sf).collect()}
    assert rows == dict(zip(docs, brute(docs.values(), tokenizers), strict=True))
