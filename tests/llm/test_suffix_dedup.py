"""Byte-level suffix dedup against brute force, its parts, and its edge cases."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from txnguard.llm import queries as Q
from txnguard.llm import suffix_dedup as S
from txnguard.llm.common import table


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, t string, doc string, ranges string, spots string")


def row(doc_id, text):
    return doc_id, text, "clash", "clash", "clash", "clash"


def naive_dedup(rows, window=50):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of every row."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - window + 1) if doc_id is not None else ():
            s = data[i : i + window]
            first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=np.int64)
        for i in range(len(data) - window + 1) if doc_id is not None else ():
            if first[data[i : i + window]] < doc_id:
                gone[i] += 1
                gone[i + window] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int(np.sum(gone & ~np.append(False, gone[:-1])))
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return [tuple(r)[:5] for r in df.collect()]


def sort_key(r):
    return tuple((x is None, x) for x in r)


def same(got, want):
    assert sorted(got, key=sort_key) == sorted(want, key=sort_key)


@pytest.mark.parametrize("small", [2, 64, 4096])
def test_multikey_order_sorts_rows(small):
    rng = np.random.default_rng(small)
    for n, c, top in [(0, 3, 5), (1, 2, 5), (5000, 4, 3), (3000, 2, 1 << 63), (2000, 6, 1)]:
        columns = [rng.integers(0, top, n).astype(np.uint64) for _ in range(c)]
        order = S.multikey_order(columns, small)
        assert sorted(order.tolist()) == list(range(n))
        rows = list(zip(*(x[order].tolist() for x in columns)))
        assert rows == sorted(rows)


def test_every_window_has_one_anchor_that_its_bytes_choose(monkeypatch):
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.choice([0, 10, 49, 50, 51, 400]))) for _ in range(60)] + [b"a" * 300]
    for stretch in (S._STRETCH, 64):
        monkeypatch.setattr(S, "_STRETCH", stretch)
        S._powers.cache_clear()
        anchor_of, seen = {}, {}
        for own, first, last, anchor, code in S.spots(texts, 50, 24):
            for i, a, b, p, c in zip(*(x.tolist() for x in (own, first, last, anchor, code))):
                assert seen.setdefault(texts[i][p : p + 24], c) == c
                for x in range(a, b + 1):
                    assert (i, x) not in anchor_of and x <= p <= x + 26
                    anchor_of[i, x] = p - x
        assert set(anchor_of) == {(i, x) for i, t in enumerate(texts) for x in range(len(t) - 49)}
        by_bytes = {}
        for (i, x), at in anchor_of.items():
            assert by_bytes.setdefault(texts[i][x : x + 50], at) == at
    S._powers.cache_clear()


def mixed(seed, n=60):
    """Documents of shared passages, near copies, exact copies and low-entropy stretches."""
    rng = random.Random(seed)
    words = ["the", "of", "é", "naïve", "transform", "a", "quick", "日本語", "x"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(passages)[rng.randrange(20) :] + rng.choice(["", " ", "qz" * rng.randrange(40), str(rng.random())]) for _ in range(rng.randrange(4)))
        if rng.random() < 0.2 and rows:
            text = rng.choice(rows)[1] or ""
        if rng.random() < 0.2 and text:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((rng.randrange(-5, n), text))
    return rows + [(None, passages[0]), (-7, None), (3, "")]


@pytest.mark.parametrize("seed, window, partitions, flush", [(0, 50, 8, 1 << 18), (1, 50, 40, 50), (2, 16, 8, 40), (3, 50, 3, 7), (4, 77, 16, 1 << 18)])
def test_dedup_against_brute_force(spark, seed, window, partitions, flush, monkeypatch):
    monkeypatch.setattr(S, "_WINDOWS", flush)
    rows = mixed(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = docs_df(spark, [row(*r) for r in rows]).repartition(5)
        want = naive_dedup(rows, window)
        same(rows_of(S.dedup(df, window, flush_spots=flush)), want)
        assert sum(r[2] for r in want) > 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_leading_bytes_are_cut_by_splitters_and_compared_across_buckets(spark):
    rng = random.Random(9)
    line = "one very common line that a third of all documents has, word for word"
    rows = [(i, f"{rng.random()} {line[: 30 + rng.randrange(40)]} {rng.random()}") for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = docs_df(spark, [row(*r) for r in rows]).repartition(7)
        same(rows_of(S.dedup(df, 50)), naive_dedup(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_suffix_dedup_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = Q.queries()["op13_suffix_dedup"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    same(rows_of(got), naive_dedup(docs))


def test_suffix_dedup_edge_cases(spark):
    text = "a text that is long enough to hold a window of fifty bytes, and then some more"
    rows = [(1, text), (1, text), (2, text), (2, None), (3, "x" + text), (4, text[:49]), (None, text), (None, None), (5, text[:-30] + text[30:])]
    found = S.dedup(docs_df(spark, [row(*r) for r in rows]))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    same(rows_of(found), naive_dedup(rows))
    for r in found.where("kept is not null").collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert S.dedup(docs_df(spark, [])).count() == 0
    with pytest.raises(ValueError):
        S.lead_bytes(15)


def test_very_long_texts(spark):
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefghij ") for _ in range(3_000_000))
    rows = [(1, long), (2, "0" * 60 + long[1_000_000:2_500_000] + "1" * 60), (3, "ab" * 500_000), (4, "ab" * 100)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in S.dedup(docs_df(spark, [row(*r) for r in rows])).collect()}
    assert got == {1: (0, 0), 2: (1_500_000, 1), 3: (0, 0), 4: (200, 1)}
