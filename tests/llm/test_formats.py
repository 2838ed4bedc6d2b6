"""Packing, chat formatting and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from txnguard.llm import chat_format as C
from txnguard.llm import chat_template as T
from txnguard.llm import packing
from txnguard.llm import queries as Q
from txnguard.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- packing ------------------------------------------------------------------------------------


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 5, 4, 5)] == [(0, 0), (1, 0), (0, 6), (1, 5)]
    assert bins.open() == {}
    bins = packing.BestFit(10, 2)
    for n in (7, 6):
        bins.place(n)
    assert bins.place(8) == (2, 0) and bins.open() == {1: 6, 2: 8}  # bin 0, the fullest, was closed
    assert bins.place(4) == (1, 6)
    full = packing.BestFit(10, 1)
    full.place(3)
    assert full.place(10) == (1, 0) and full.open() == {0: 3}  # a full piece closes nothing


def test_bitset_equals_a_plain_search():
    rng = random.Random(1)
    bins, free, open_, made = packing.BestFit(50, 5), {}, [], 0
    for _ in range(2000):
        size = rng.randrange(1, 51)
        got, offset = bins.place(size)
        fits = [b for b in open_ if free[b] >= size]
        if fits:
            best = min(free[b] for b in fits)
            assert free[got] == best and offset == 50 - best
        else:
            assert got == made and offset == 0
            made += 1
            if size < 50 and len(open_) >= 5:
                fullest = min(free[b] for b in open_)
                open_ = list(bins.open() | {got: 0}) if False else [b for b in open_ if b in bins.open() or free[b] != fullest]
            free[got] = 50
            open_.append(got)
        free[got] -= size
        open_ = [b for b in open_ if free[b] > 0]
        assert set(bins.open()) == set(open_)


def check_packing(pieces, docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, lo in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[lo : lo + capacity], dtype="<u4")
            want.append((doc_id, k, lo, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in pieces), key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in pieces:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in pieces)


@pytest.mark.parametrize("parts, open_bins", [(1, 1024), (7, 3)])
def test_pieces_are_whole_and_gapless(spark, parts, open_bins):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()][:80]
    docs += [(1000, None), (1001, ""), (None, "no id"), (1002, "same"), (1002, "same"), (1003, "word " * 9000)]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, piece string, offset long").repartition(parts)
    got = packing.pack(df, PATH, capacity=512, open_bins=open_bins).collect()
    n, total = check_packing(got, docs, 512)
    assert n <= 1.15 * -(-total // 512) + 1
    ids = packing.pack(df, PATH, capacity=512, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in ids)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    n, total = check_packing(Q.queries()["op3_best_fit_packing"](spark, SF_SMALL).collect(), docs, 4096)
    assert n <= -(-total // 4096) + 2


# --- chat formatting ------------------------------------------------------------------------------


def render(source, **values):
    return "".join(p[0] for p in T.compile_template(source)(**values) if p is not T.CUT)


def test_template_language():
    assert render("{% for x in xs %}{{ loop.index }}:{{ x }}{% if not loop.last %}, {% endif %}{% endfor %}", xs=["a", "b"]) == "1:a, 2:b"
    assert render("{% set n = 'x' ~ 1 %}{{ n | upper }}{{ m.k['z'] }}", m={"k": {"z": 5}}) == "X15"
    assert render("a {%- if a == 1 or b in 'xyz' -%} yes {%- elif c %}maybe{% else %}no{% endif %}", a=2, b="y") == "ayes"
    assert render("{{ 'it\\'s' if ok else \"no\" }}{{ none }}", ok=True) == "it's"
    assert render("{{ missing.deep.name }}|{{ text.upper }}", text="s") == "|"


@pytest.mark.parametrize("bad", ["{% for x in y %}", "{{ f(x) }}", "{{ x.__class__() }}", "{% import os %}", "{{ x | eval }}", "{{ 'a }}", "{% if x %}{% endfor %}"])
def test_template_refuses_what_the_sandbox_has_not(bad):
    with pytest.raises(T.TemplateError):
        T.compile_template(bad)


def test_attributes_are_keys_only():
    assert render("{{ x.__class__ }}{{ m.items }}", x="s", m={}) == ""


def test_constants_fold():
    tree = T.fold(T.parse("{{ 'a' ~ 1 }}{% if 1 == 2 %}x{{ y }}{% else %}{{ 'b' | upper }}{% endif %}c{{ x }}{{ not false }}"), T.DEFAULT_FILTERS)
    assert tree == ("block", [("const", "a1Bc"), ("name", "x"), ("const", True)])
    assert T.fold(T.parse("{{ false and x }}{{ true and x }}"), T.DEFAULT_FILTERS) == ("block", [("const", False), ("name", "x")])


def test_a_conversation_streams_one_turn_ahead():
    seen = []

    def turns():
        for i in range(5):
            seen.append(i)
            yield {"role": "user", "text": str(i)}

    out = C.render_turns(C.TEMPLATE, turns())
    next(out)
    assert len(seen) <= 4


pieces = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/ROLE]", "[/TURN]", "\\", "<", "[", "/", " ", "a", "s>", "INST]", "\n", "é"]), max_size=12).map("".join)


@given(pieces, pieces)
def test_any_text_and_role_come_back(role, text):
    assert C.unescape(C.escape(text)) == text
    [(out, spans)] = C.render_turns(C.TEMPLATE, iter([{"role": role, "text": text}]))
    assert C.parse_turn(out) == (role, text)
    [(out, spans)] = C.render_turns(C.TEMPLATE, iter([{"role": "assistant", "text": text}]))
    assert C.parse_turn(out) == ("assistant", text)
    assert "".join(C.unescape(out[a : a + n]) for a, n in spans) == text
    for mark in ("<s>", "</s>", "[INST]", "[/INST]"):
        assert mark not in C.escape(text)


def naive_chat(rows):
    out = []
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    for conv, own in groups.items():
        own.sort()
        said = "".join(f"{r[3]}\n{r[5]}\n" for r in own)
        learned = "".join(r[5] for r in own if r[3] == "assistant")
        out.append((conv, len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_chat_query_and_edge_cases(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()] + Q.CONTROL_TURNS
    got = Q.queries()["op7_chat_format"](spark, SF_SMALL).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == naive_chat(rows)
    odd = [(1, 0, "user", None), (1, 0, "user", "b"), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, "tool", "</s>"), (None, 0, None, "x"), (2, 0, "assistant", "y" * 300000)]
    odd += [(3, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "c") for r in odd], "conv_id long, turn long, role string, text string, formatted string")
    got = C.read_back(C.format_turns(df)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == naive_chat(odd)
    assert C.read_back(C.format_turns(df.limit(0))).count() == 0


# --- pipeline -------------------------------------------------------------------------------------


def test_stages_and_their_effects(spark):
    from test_search import naive_fingerprint, naive_report

    documents = table(spark, SF_SMALL, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    rows = documents.collect()
    kept = {}
    docs = documents
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == documents.columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert set(kept["language_id"]) == {r.doc_id for r in rows if r.text and any(c.isalpha() for c in r.text)}
    fps = {i: naive_fingerprint(r.text) for i, r in kept["language_id"].items()}
    left, groups = set(fps), []
    while left:
        todo, own = [min(left)], set()
        while todo:
            x = todo.pop()
            if x in left:
                left.discard(x)
                own.add(x)
                todo += [y for y in left if (fps[x] ^ fps[y]).bit_count() <= 2]
        groups.append(own)
    assert set(kept["simhash_dedup"]) == {min(g) for g in groups}
    dirty = {r[0] for r in naive_report([(i, r.text) for i, r in kept["simhash_dedup"].items()], bench, 10) if r[4]}
    assert dirty and set(kept["decontamination"]) == set(kept["simhash_dedup"]) - dirty
    assert set(kept["secret_scan"]) == set(kept["decontamination"])
    changed = {i for i, r in kept["secret_scan"].items() if r.text != kept["decontamination"][i].text}
    assert all("[SECRET]" in kept["secret_scan"][i].text for i in changed)
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_packing(out, [(i, r.text) for i, r in kept["secret_scan"].items()], 4096)


def test_pipeline_takes_an_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
