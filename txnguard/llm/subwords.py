"""Subword ids by a public tokenizer, as fast as its vocabulary of words allows.

``encoder(path)`` returns a function from texts to the little-endian 32-bit ids
that the tokenizer's own ``encode(text, add_special_tokens=False)`` gives. It is
for BPE files with a word-end suffix, whose pre-tokenizer drops white space:
merges never cross what the pre-tokenizer splits, so each distinct part of a word
is encoded once and then looked up. Parts of Latin letters are encoded by
tiktoken over an alphabet in which a word's last letter is a letter of its own;
other new parts go through the tokenizer's model together, and the word-end
suffix tells them apart again. Words with characters on which regular-expression
and Unicode libraries may differ go through the whole tokenizer.

A lookup table has two generations of at most ``table_bytes`` / 2 each: when the
younger is full it becomes the older one, whose words move up again as they are
met, so frequent words are never learned twice. A worker keeps its tables for the
next task; they hold 96 MB at most, whatever words come.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

_TABLE_BYTES = 64 << 20  # of words, and half as much of parts of words, that a worker remembers
_ENTRY = 190  # bytes of an entry beside its text and ids
_LONG = 64  # bytes; longer words are not remembered
_LETTERS = 1 << 16  # ranks from here on are ids, below are letters
_LATIN = "[A-Za-zÀ-ÖØ-öø-įı-ž]"  # letters up to U+017E whose lower case is one of them


class Table:
    """A bounded lookup table in two generations."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.young, self.old, self.held = {}, {}, 0

    def missing(self, keys: set) -> list:
        """The keys that no generation has; the others are in the younger one afterwards."""
        new = list(keys.difference(self.young))
        if self.old:
            both = self.old.keys() & new
            self.put(both, [self.old[k] for k in both])
            new = [k for k in new if k not in both]
        return new

    def put(self, keys, values: list[bytes]) -> None:
        self.young.update(zip(keys, values, strict=True))
        self.held += _ENTRY * len(values) + sum(map(len, keys)) + sum(map(len, values))

    def age(self) -> None:
        """Call it when nothing that was asked for is needed any more."""
        if self.held > self.limit // 2:
            self.young, self.old, self.held = {}, self.young, 0


def _latin_model(spec: dict, alphabet: dict[str, int]):
    """A tiktoken encoding of lower-case Latin words, one a line, and the ids of its ranks. Plain bytes of letters are the letters
    a-z or characters from U+0100 on, bytes at a word's end A-Z or characters from U+0200 on; both are merged first."""
    import tiktoken

    suffix, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
    if sorted(merged) != merged:
        raise ValueError("the merges don't stand in the order of their ids")
    ranks = {bytes([b]): b for b in range(256)}
    for b in range(0x80, 0x100):
        for k, base in enumerate((0x100, 0x200)):
            ranks[chr(base + b).encode()] = 256 + 128 * k + b - 0x80
    ids = {}
    for token, i in vocab.items():
        end = token.endswith(suffix) and token != suffix
        raw = [alphabet.get(c) for c in (token[: -len(suffix)] if end else token)]
        if not raw or any(b is None or not (0x61 <= b <= 0x7A or b >= 0x80) for b in raw):
            continue
        letters = [chr(b if b < 0x80 else 0x100 + b) for b in raw]
        if end:
            letters[-1] = chr(raw[-1] - 32 if raw[-1] < 0x80 else 0x200 + raw[-1])
        key = "".join(letters).encode()
        ids[ranks.setdefault(key, _LETTERS + i)] = i
    return tiktoken.Encoding("latin", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={}), ids


@lru_cache(maxsize=4)
def encoder(path: str, table_bytes: int = _TABLE_BYTES) -> Callable[[list[str]], list[bytes]]:
    import numpy as np
    import regex
    from tokenizers import Tokenizer

    from txnguard.llm.common import byte_alphabet

    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + "|\n")
    # up to U+024F composition changes nothing and lower case is the same everywhere; 1C to 1F are white
    # space to some libraries; added tokens are matched before the text is normalised
    odd = regex.compile("[\x1c-\x1fɐ-\U0010ffff]|" + "|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}))
    suffix = spec["model"]["end_of_word_suffix"]
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    ends[[i for x, i in tokenizer.get_vocab().items() if x.endswith(suffix)]] = True
    latin, id_of = _latin_model(spec, byte_alphabet())
    known = np.zeros(max(id_of) + 1, dtype="<u4")
    known[list(id_of)] = list(id_of.values())
    latin_words = regex.compile(f"^{_LATIN}+$", flags=regex.MULTILINE)
    latin_part = regex.compile(f"{_LATIN}+")
    words, parts = Table(table_bytes), Table(table_bytes // 2)

    def cut(ids: np.ndarray, after: np.ndarray) -> list[bytes]:
        raw, start, out = ids.astype("<u4").tobytes(), 0, []
        for end in (after * 4).tolist():
            out.append(raw[start:end])
            start = end
        return out

    def latin_ids(text: str) -> list[bytes]:
        """Ids of lower-case Latin parts, one a line."""
        data = np.frombuffer((text + "\n").encode(), np.uint8)
        high = data >= 0x80
        at = np.flatnonzero(high)
        own = data[at]
        data = np.repeat(data, 1 + high)
        at += np.arange(len(at))
        data[at], data[at + 1] = 0xC6 + (own >> 6 & 1), 0x80 | (own & 0x3F)  # U+0100 and the byte
        last = np.flatnonzero(data == 10) - 1
        ascii_end = data[last] < 0x80
        data[last[ascii_end]] -= 32
        data[last[~ascii_end] - 1] += 4  # U+01xx to U+02xx
        ranks = np.array(latin.encode_ordinary(data.tobytes().decode()), dtype=np.int64)
        stop = ranks == 10
        return cut(known[ranks[~stop]], np.cumsum(~stop)[stop])

    def encoded(new: list[bytes]) -> Iterator[tuple[list[bytes], list[bytes]]]:
        """Distinct words and their ids, by kinds of words."""
        text = b"\n".join(new).decode()
        if odd.search(text):
            special = [w for w in new if odd.search(w.decode())]
            yield special, [np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes() for w in special]
            new = list(set(new).difference(special))
            text = b"\n".join(new).decode()
        whole = "\n".join(latin_words.findall(text))
        if whole:
            keys = whole.encode().split(b"\n")
            yield keys, latin_ids(whole.lower())
            new = list(set(new).difference(keys))
            text = b"\n".join(new).decode()
        if not new:
            return
        found = split.findall(text.lower())
        distinct = set(found) - {"\n"}
        of_letters = [p for p in distinct if latin_part.fullmatch(p)]
        table = dict(zip(of_letters, latin_ids("\n".join(of_letters)), strict=True)) if of_letters else {}
        rest = parts.missing(distinct.difference(table))
        for lo in range(0, len(rest), 4096):
            some = rest[lo : lo + 4096]
            ids = np.array(bare.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            parts.put(some, cut(ids, np.flatnonzero(ends[ids]) + 1))
        table |= {p: parts.young[p] for p in distinct if p not in table}
        own, made = [], []
        for part in found:
            if part == "\n":
                made.append(b"".join(own))
                own = []
            else:
                own.append(table[part])
        yield new, [*made, b"".join(own)]
        parts.age()

    def fresh(new: list[bytes]) -> list[bytes]:
        """The ids of distinct words without white space, which are not looked up before nor remembered."""
        table: dict[bytes, bytes] = {}
        for keys, raw in encoded(new):
            table.update(zip(keys, raw, strict=True))
        return list(map(table.__getitem__, new))

    def looked_up(asked: set[bytes], out: Callable[[dict[bytes, bytes]], list[bytes]]) -> list[bytes]:
        new = words.missing(asked)
        if new:
            for keys, raw in encoded(new):
                words.put(keys, raw)
        table = words.young
        found = out(table)
        for w in [w for w in new if len(w) > _LONG]:
            words.held -= _ENTRY + len(w) + len(table.pop(w))
        words.age()
        return found

    def encode(texts: list[str]) -> list[bytes]:
        """Call it with slices of ``small_batches``: the new words of a call are held at once."""
        split_texts = [t.encode().split() for t in texts]
        return looked_up(set().union(*split_texts), lambda table: [b"".join(map(table.__getitem__, own)) for own in split_texts])

    encode.fresh = fresh
    return encode
