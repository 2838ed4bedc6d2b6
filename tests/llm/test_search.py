"""Near-duplicates, decontamination and substring dedup against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from txnguard.llm import components as CC
from txnguard.llm import decontaminate as D
from txnguard.llm import queries as Q
from txnguard.llm import simhash_gray as S
from txnguard.llm import substring_dedup as B
from txnguard.llm.common import table
from txnguard.llm.oracle import oracle_sql


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, t string, key string, words string, component string")


def row(doc_id, text):
    return doc_id, text, "clash", "clash", "clash", "clash"


# --- SimHash ----------------------------------------------------------------------------


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clustered_codes(seed, n=30, copies=40):
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(copies):
            x = base
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


def close_pairs(codes, bits):
    return {(int(a), int(b)) for i, a in enumerate(codes) for b in codes[i + 1 :] if int(a ^ b).bit_count() <= bits}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_index_finds_exactly_the_close_pairs_of_each_bucket(bits):
    codes = clustered_codes(bits)
    sizes = np.array([len(codes) // 3, 1, len(codes) - 1 - len(codes) // 3])
    buckets, lo = [], 0
    for n in sizes:
        own = codes[lo : lo + n]
        buckets.append(own[np.argsort(S.gray_rank(own))])
        lo += n
    flat = np.concatenate(buckets)
    i, j = S.search(flat, sizes, bits)
    got = sorted(tuple(sorted((int(a), int(b)))) for a, b in zip(flat[i], flat[j]))
    assert got == sorted(p for own in buckets for p in close_pairs(np.sort(own), bits))


def test_gray_rank_orders_the_gray_sequence():
    ranks = np.arange(64, dtype=np.uint64)
    assert (S.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


@pytest.mark.parametrize("bucket_rows", [2048, 16])
def test_links_lose_nothing_however_often_buckets_are_dealt_again(spark, bucket_rows):
    codes = clustered_codes(7, n=6, copies=60)
    df = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "fp long")
    mask = (1 << 64) - 1
    got = [tuple(sorted((r.a & mask, r.b & mask))) for r in S.links(df, 2, bucket_rows).collect()]
    assert sorted(got) == sorted(close_pairs(codes, 2))


def test_components_of_chains_stars_and_random_edges(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, k) for k in range(6000, 6060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.vertex: r.component for r in CC.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert CC.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [row(5, text), row(2, text), row(2, text), row(9, text + " x"), row(1, None), row(3, ""), row(4, " \n"), row(None, text), row(6, "one two"), row(7, "a b c d " * 20000)]
    found = S.near_duplicates(docs_df(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        texts = {x[1] for x in rows if x[0] == r.doc_id}
        assert r.fp & ((1 << 64) - 1) in {naive_fingerprint(t) for t in texts}
    ids = {r.doc_id: r.component_id for r in found}
    assert (ids[5], ids[2], ids[None], ids[1], ids[3], ids[4], ids[6]) == (2, 2, 2, 1, 1, 1, 6)
    kept = S.one_of_each(docs_df(spark, rows))
    assert kept.columns == docs_df(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({v for v in ids.values()})
    empty = docs_df(spark, [])
    assert S.near_duplicates(empty).count() == 0 and S.one_of_each(empty).count() == 0
    nameless = docs_df(spark, [row(None, "same text here"), row(None, "same text here")])
    assert S.one_of_each(nameless).count() == 1


def test_simhash_query_against_all_pairs(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    fps = {r.doc_id: naive_fingerprint(r.text) for r in docs}
    label = {i: i for i in fps}
    for _ in fps:
        before = dict(label)
        for a in fps:
            label[a] = min(label[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 2)
        if before == label:
            break
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.queries()["op2_simhash_gray"](spark, SF_SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", label[i]) for i in fps}


# --- decontamination ----------------------------------------------------------------------


def naive_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def naive_report(docs, bench, window):
    spans = {}
    for item_id, text in bench:
        w = naive_words(text)
        for p in range(max(1, len(w) - window + 1) if w else 0):
            spans.setdefault(tuple(w[p : p + window]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, items = naive_words(text), set(), set()
        for x, ids in spans.items():
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p : p + len(x)]) == x:
                    hit |= set(range(p, p + len(x)))
                    items |= ids - {None}
        out.append((doc_id, len(w), len(hit), sorted(map(str, items)), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_report_equals_brute_force(spark, broadcast_bytes):
    rng = random.Random(11)
    word = lambda: rng.choice(["Ab", "c", "dé", "É", "ee", "f1"])
    bench = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([6, 5, 4, 3, 2, 1, 9])] + [(7, None), (8, "..."), (None, "zz yy xx ww"), (0, "c c c c c")]
    bench[5] = (5, "lonely")
    docs = [(i, ", ".join(word() for _ in range(rng.randrange(0, 60)))) for i in range(25)]
    docs += [(3, docs[3][1]), (3, "lonely"), (50, None), (51, ""), (None, "zz-YY xx.ww"), (52, "c " * 3000)]
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, w string, words string")
    b = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, w string")
    got = D.report(d, b, window=4, broadcast_bytes=broadcast_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=repr) == naive_report(docs, bench, 4)
    clean = D.clean(d, b, window=4, broadcast_bytes=broadcast_bytes)
    assert clean.columns == d.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(
        repr((i, t)) for i, t in docs if not naive_report([(i, t)], bench, 4)[0][4]
    )


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [r.contaminated for r in D.report(docs, bench.limit(0)).collect()] == [False]
    assert D.report(docs.limit(0), bench).count() == 0
    assert D.clean(docs, bench.limit(0)).count() == 1


def test_decontamination_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    want = con.execute(oracle_sql()["op5_decontamination"]).df().sort_values("doc_id", ignore_index=True)
    got = Q.queries()["op5_decontamination"](spark, SF_SMALL).toPandas().sort_values("doc_id", ignore_index=True)[list(want.columns)]
    assert want.contaminated.any() and got.equals(want.astype(got.dtypes.to_dict()))


def test_native_operators_run_no_python(spark):
    from txnguard.llm import secret_scan
    from txnguard.plans import inspect as P

    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    for df in (D.report(docs, bench), D.clean(docs, bench), secret_scan.scan(docs), secret_scan.redacted(docs)):
        assert not re.search("Python|Pandas|Arrow", P.formatted_plan(df).replace("ArrowEvalless", ""))


# --- substring dedup ------------------------------------------------------------------------


def naive_dedup(docs, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in split:
        if i is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("flush_windows, bucket_bytes", [(2_000_000, 16 << 20), (40, 64)])
def test_dedup_equals_brute_force(spark, flush_windows, bucket_bytes):
    rng = random.Random(5)
    passages = [[f"p{j}_{k}" for k in range(rng.randrange(8, 30))] for j in range(6)]
    docs = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) - 4)
            w += p[a : a + rng.randrange(4, 30)] if rng.random() < 0.5 else p
            w += [f"u{rng.randrange(9)}" for _ in range(rng.randrange(4))]
        docs.append((i, " ".join(w)))
    line = " ".join(f"l{k}" for k in range(9))
    docs += [(100, docs[7][1]), (101, docs[7][1]), (100, docs[7][1]), (102, " \n".join([line] * 30)), (103, line), (99, line + " tail"), (104, None), (105, ""), (None, line), (106, "a " * 3000), (107, "a " * 200)]
    df = docs_df(spark, [row(i, t) for i, t in docs]).repartition(3)
    got = B.dedup(df, window=8, flush_windows=flush_windows, bucket_bytes=bucket_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == naive_dedup(docs, 8)
    for r in got:
        assert r.kept is None or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_dedup_query_equals_brute_force_and_takes_an_empty_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = Q.queries()["op9_substring_dedup"](spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == naive_dedup(docs, 50)
    assert B.dedup(docs_df(spark, [])).count() == 0


def test_registered_text_queries_read_whole_tables():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.queries()) == list(range(1, 14))
