"""Periodic runs and cross-tokenizer alignment against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from txnguard.llm import periodic_runs as R
from txnguard.llm import queries as Q
from txnguard.llm import token_alignment as A
from txnguard.llm.common import table

BYTE, PIECE = (public_tokenizers.path(x) for x in (Q.BYTE_BPE, Q.PIECE_BPE))


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, runs string, pair string, n string, row string")


def row(doc_id, text):
    return doc_id, text, "clash", "clash", "clash", "clash"


# --- periodic runs ------------------------------------------------------------------------


def naive_lyndon(codes):
    def lyndon(s):
        return 0 not in s and all(s < s[k:] for k in range(1, len(s)))

    return [max((n for n in range(1, len(codes) - i + 1) if lyndon(codes[i : i + n])), default=0) for i in range(len(codes))]


def naive_runs(w, min_length=6, min_exponent=4):
    out = []
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n, root = i + q - start, w[start : start + q]
            if n >= max(min_length, min_exponent * q) and not any(q % p == 0 and root == root[:p] * (q // p) for p in range(1, q)):
                out.append((start, n, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng, letters=b"abc"):
    w = []
    for _ in range(rng.randrange(4)):
        root = [bytes([rng.choice(letters)]) for _ in range(rng.randrange(1, 6))]
        w += (root * 7)[: rng.randrange(1, 40)] + [bytes([rng.choice(b"abcdefgh")]) for _ in range(rng.randrange(10))]
    return w


def test_lyndon_array_of_random_sequences():
    rng = random.Random(1)
    for _ in range(300):
        codes = [0] + [rng.randrange(rng.random() > 0.1, rng.choice([2, 3, 4]) + 1) for _ in range(rng.randrange(1, 22))] + [0]
        assert R.lyndon_array(codes) == naive_lyndon(codes)


@pytest.mark.parametrize("length, exponent", [(6, 4), (2, 2), (3, 3), (30, 2)])
def test_runs_of_random_sequences(length, exponent):
    rng = random.Random(length)
    for _ in range(400):
        docs = [repetitive(rng) for _ in range(rng.randrange(1, 5))]
        for w, found in zip(docs, R.find_runs(docs, length, exponent)):
            assert [tuple(r) for r in found.tolist()] == naive_runs(w, length, exponent)


def test_words_outside_runs_are_cut_away_before_the_grouping(monkeypatch):
    seen = []
    lyndon = R.lyndon_array
    monkeypatch.setattr(R, "lyndon_array", lambda codes: seen.append(len(codes)) or lyndon(codes))
    rng = random.Random(2)
    prose = [b"w%d" % rng.randrange(2000) for _ in range(40_000)]
    words = prose[:20_000] + [b"x", b"y"] * 10 + prose[20_000:]
    assert [tuple(r) for r in R.find_runs([words])[0].tolist()] == [(20000, 20, 2)]
    assert max(seen) < 100


def expected_runs(doc_id, text):
    w, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len((text or "").encode().split())
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = naive_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *figures, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_runs_query_against_brute_force(spark):
    docs = [r for r in table(spark, SF_SMALL, "documents").collect() if len(r.text or "") < 12_000]
    want = {r.doc_id: expected_runs(r.doc_id, r.text) for r in docs}
    got = {r.doc_id: tuple(r)[1:] for r in Q.queries()["op11_periodic_runs"](spark, SF_SMALL).collect()}
    assert {k: got[k] for k in want} == want and len(got) == table(spark, SF_SMALL, "documents").count()
    assert sum(v[0] for v in want.values()) > 10


def test_periodic_runs_edge_cases(spark):
    line = "to be or not to be "
    rows = [row(1, None), row(2, ""), row(3, " \n\t"), row(4, "a a a a a a"), row(4, "a a a a a a"), row(None, "x y " * 5), row(5, line * 3), row(6, line * 30_000), row(7, "a" * 2_000_000), row(8, "é é é é " * 4)]
    found = {}
    for r in R.detect(docs_df(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert found[1] == found[2] == found[3] == [(0, [], "")]
    assert found[4] == [(6, [(0, 6, 1)], "a")] * 2 and found[None] == [(10, [(0, 10, 2)], "x y")]
    assert found[5] == [(18, [], (line * 3).strip())]
    assert found[6] == [(180_000, [(0, 180_000, 6)], line.strip())]
    assert found[7] == [(1, [], "a" * 2_000_000)] and found[8] == [(8, [(0, 8, 1)], "é é")]
    assert R.detect(docs_df(spark, [])).count() == 0


# --- alignment ----------------------------------------------------------------------------


def naive_alignment(texts):
    """Per text: n_a, n_b, groups, links as a Counter of pairs, the groups' text."""
    va, vb = A.byte_level(BYTE), A.pieces(PIECE)
    theirs = Tokenizer.from_file(BYTE)
    theirs.encode_special_tokens = True
    out = []
    for text in texts:
        a = theirs.encode(" " + text, add_special_tokens=False).ids if text else []
        b = vb.encode([text])[0] if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(va.token[i] for i in a) != whole or b"".join(vb.token[i] for i in b) != whole:
            a, b = [], []
        groups, at_a, at_b, end = [], 0, 0, [0, 0]
        ends = [np.cumsum([len(v.token[i]) for i in ids]).tolist() for v, ids in ((va, a), (vb, b))]
        for stop in sorted(set(ends[0]) & set(ends[1])):
            to_a, to_b = ends[0].index(stop, at_a) + 1, ends[1].index(stop, at_b) + 1
            groups.append((a[at_a:to_a], b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        pairs = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        listed = "|".join(f"{','.join(map(str, ga))};{','.join(map(str, gb))}" for ga, gb in groups)
        out.append((len(a), len(b), len(groups), pairs, listed.replace(";", "\0").replace("|", ";").replace("\0", "|") if groups else ""))
    return out


def expected_alignment(texts):
    found = naive_alignment(texts)
    counts = Counter(p for f in found for p in f[3])
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    rows = []
    for n_a, n_b, n_groups, pairs, listed in found:
        best = sum(n for p, n in pairs.items() if counts[p] == top[p[0]])
        total = sum(n * counts[p] for p, n in pairs.items())
        rows.append((n_a, n_b, n_groups, sum(pairs.values()), best, total, hashlib.sha256(listed.encode()).hexdigest() if listed else ""))
    return rows


def test_gustavson_product_equals_dense_product():
    rng = np.random.default_rng(4)
    for n, m, k in [(5, 7, 6), (1, 1, 1), (12, 3, 9), (0, 4, 2)]:
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.5) for s in ((n, m), (m, k)))
        a, b = (A.Csr(np.concatenate([[0], np.cumsum((z != 0).sum(1))]), np.nonzero(z)[1], z[np.nonzero(z)], z.shape[1]) for z in (x, y))
        for block in (1, 3, 1 << 20):
            got = np.zeros((n, k), dtype=np.int64)
            for i, j, v in A.product(a, b, block):
                np.add.at(got, (i, j), v)
            assert (got == x @ y).all()
        back = a.transposed().transposed()
        assert (back.ptr == a.ptr).all() and (back.cols == a.cols).all() and (back.vals == a.vals).all()


ODD = ["a", " ", "  two  spaces ", "tabs\t\tand\nlines\r\n", "x<|endoftext|>y <s> </s> <0x0A>", "already ▁ there", "漢字かな 😀😀 é é", "\x00", "it's I'LL 12345 ***", "a" * 3000, "ｆｕｌｌ ﬁ 　  "]


@pytest.mark.parametrize("block", [1 << 21, 7])
def test_links_and_groups_of_odd_texts(monkeypatch, block):
    monkeypatch.setattr(A.product, "__defaults__", (block,))
    va, vb = A.byte_level(BYTE), A.pieces(PIECE)
    for text, (n_a, n_b, n_groups, pairs, listed) in zip(ODD, naive_alignment(ODD)):
        if not n_a:
            continue
        own = A.Batch([np.array(va.encode([text])[0])], [np.array(vb.encode([text])[0])], va.size, vb.size)
        _, pair, times = own.links(len(vb.token))
        assert (own.n_a[0], own.n_b[0], own.n_groups[0]) == (n_a, n_b, n_groups)
        assert dict(zip(map(divmod, pair.tolist(), [len(vb.token)] * len(pair)), times.tolist())) == pairs
        assert next(own.texts(60_000)).decode() == listed


def test_alignment_query_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    want = {r.doc_id: x for r, x in zip(docs, expected_alignment([r.text for r in docs]))}
    got = {r.doc_id: tuple(r)[1:] for r in Q.queries()["op12_token_alignment"](spark, SF_SMALL).collect()}
    assert got == want


@pytest.mark.parametrize("broadcast_pairs", [0, 50, 1 << 21])
def test_alignment_edge_cases_and_rare_pairs_by_join(spark, broadcast_pairs):
    texts = [None, "", *ODD, "same text twice", "same text twice", "the same text as the others " * 20_000]
    ids = [None, *range(2, len(texts) + 1)]
    want = expected_alignment([t or "" for t in texts])
    found = A.align(docs_df(spark, [row(i, t) for i, t in zip(ids, texts)]), BYTE, PIECE, broadcast_pairs, with_groups=True).collect()
    got = {r.doc_id: tuple(r)[1:8] for r in found}
    assert got == dict(zip(ids, want))
    assert all((hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") == r.groups_sha256 for r in found)
    assert A.align(docs_df(spark, []), BYTE, PIECE, broadcast_pairs).count() == 0
