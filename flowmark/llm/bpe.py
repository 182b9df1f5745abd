"""Encoding with a public byte-level BPE tokenizer (problem 8) as a finite-state transducer built while it runs.

Within a pre-token, the encoding of every prefix is known from the encodings of shorter ones: its last token is the longest
suffix token that may follow the last token before it (two tokens may be neighbours exactly if encoding their joined bytes
gives the two back). A state is the last emitted token and the bytes after it; a boundary is emitted as soon as the
encodings of all prefixes at which a later token could still begin agree on it, so the lookahead is bounded by the longest
token. States and transitions are made on demand and kept (lazy determinisation), up to a bound on memory.

Defined ids: empty and null texts give an empty list. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("FLOWMARK_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# Fixed value: the pre-token pattern that the public vocabulary was made with.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What it comes to for ASCII texts, with letters, digits and blanks written out.
PLAIN_PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"

MOST_STATES, MOST_WORDS, MOST_PAIRS = 200_000, 200_000, 500_000  # about 300 MB a process


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.openings = {t[:i] for t in ranks for i in range(1, len(t))}
        self.any_split, self.plain_split = regex.compile(PRE_TOKENS).findall, re.compile(PLAIN_PRE_TOKENS).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.text_of = {v: k for k, v in ranks.items()}
        self.words: dict[str, tuple[int, ...]] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states; between pre-tokens only."""
        self.ids: dict[tuple[int | None, bytes], int] = {}
        self.keys: list[tuple[int | None, bytes]] = []
        self.lasts: list[list[int]] = []  # per state: last token of each prefix of its pending bytes
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.ends: list[tuple[int, ...]] = []
        self._state(None, b"", [])

    def merged(self, b: bytes) -> list[bytes]:
        """The encoding of a few bytes by repeated merging of the best-ranked neighbours."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 1:
            ranks = [self.ranks.get(x + y, 1 << 60) for x, y in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            x, y = self.text_of[a], self.text_of[b]
            known = self.pairs[a, b] = x + y not in self.ranks and self.merged(x + y) == [x, y]
        return known

    def _path(self, last: list[int], at: int) -> list[int]:
        out = []
        while at:
            out.append(last[at - 1])
            at -= len(self.text_of[last[at - 1]])
        return out[::-1]

    def _state(self, before: int | None, pending: bytes, last: list[int]) -> int:
        s = self.ids[before, pending] = len(self.keys)
        self.keys.append((before, pending))
        self.lasts.append(last)
        self.moves.append({})
        self.ends.append(tuple(self._path(last, len(pending))))
        return s

    def _move(self, s: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, pending = self.keys[s]
        pending = pending + bytes((byte,))
        last, n = list(self.lasts[s]), len(pending)
        for p in range(max(0, n - self.longest), n):
            token = self.ranks.get(pending[p:])
            if token is not None:
                left = last[p - 1] if p else before
                if left is None or self.neighbours(left, token):
                    last.append(token)
                    break
        else:
            raise ValueError("not a vocabulary of byte-level merges")
        openings, emitted = self.openings, []
        live = [p for p in range(max(0, n - self.longest), n) if pending[p:] in openings]
        if not live or live[0]:
            paths = [self._path(last, p) for p in (*live, n)]
            agreed = 0
            for column in zip(*paths):
                if any(x != column[0] for x in column[1:]):
                    break
                agreed += 1
            emitted = paths[0][:agreed]
            if emitted:
                cut = sum(len(self.text_of[t]) for t in emitted)
                before, pending, last = emitted[-1], pending[cut:], last[cut:]
        to = self.ids.get((before, pending))
        if to is None:
            to = self._state(before, pending, last)
        self.moves[s][byte] = out = (to, tuple(emitted))
        return out

    def word(self, w: str) -> tuple[int, ...]:
        """Ids of one pre-token. Where a long one fills the states, they are forgotten but for the present one, so that memory stays bounded inside it too."""
        out: list[int] = []
        s, moves = 0, self.moves
        for byte in w.encode():
            step = moves[s].get(byte)
            if step is None:
                if len(self.keys) > MOST_STATES:
                    (before, pending), last = self.keys[s], self.lasts[s]
                    self.reset()
                    s, moves = self.ids.get((before, pending)), self.moves
                    s = self._state(before, pending, last) if s is None else s
                step = self._move(s, byte)
            s, emitted = step
            if emitted:
                out += emitted
        out += self.ends[s]
        return tuple(out)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        return self.plain_split(text) if text.isascii() else self.any_split(text)

    def parts(self, text: str | None) -> list[tuple[int, ...]]:
        """The ids of each pre-token of a text."""
        if not text:
            return []
        words, found = self.words, self.split(text)
        got = list(map(words.get, found))
        if None in got:
            for i, ids in enumerate(got):
                if ids is None:
                    w = found[i]
                    ids = got[i] = words.get(w) or self.word(w)
                    if len(w) <= 24:
                        if len(words) > MOST_WORDS:
                            words.clear()
                        words[w] = ids
        return got

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))

    def count(self, text: str | None) -> int:
        return sum(map(len, self.parts(text)))


@lru_cache(maxsize=2)
def transducer(path: str = VOCABULARY) -> Transducer:
    with open(path, "rb") as f:
        return Transducer({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


class Utf8Decoder:
    """Incremental UTF-8 state machine: bytes of tokens in, characters out as soon as they are complete.

    The state is the number of continuation bytes still due, the range the next one must lie in, and the bits so far. A byte
    that can't follow gives one replacement character per broken sequence, as the standard recommends.
    """

    def __init__(self):
        self.due, self.low, self.high, self.bits = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.due:
                if self.low <= b <= self.high:
                    self.bits, self.due, self.low, self.high = self.bits << 6 | b & 0x3F, self.due - 1, 0x80, 0xBF
                    if not self.due:
                        out.append(chr(self.bits))
                    continue
                self.due = 0
                out.append("�")
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.due = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                self.bits = b & (0x3F >> self.due)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        due, self.due = self.due, 0
        return "�" if due else ""


def decode(ids: list[int], path: str = VOCABULARY) -> str:
    """Text of ids, token by token."""
    t, d = transducer(path), Utf8Decoder()
    return "".join(d.feed(t.text_of[i]) for i in ids) + d.close()


def _encoder(path: str, keep: list[str], counts: bool):
    def run(batches):
        made = transducer(path)
        work = made.count if counts else made.encode
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):  # what a batch of long texts gives stays small
                b = batch.slice(at, 1000)
                ids = [work(x) for x in b["_text"].to_pylist()]
                col = pa.array(ids, pa.int64() if counts else pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), col], names=[*keep, "n_tokens" if counts else "ids"])

    return run


def _run(df: DataFrame, text: str, keep: list[str], path: str, counts: bool) -> DataFrame:
    rows = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return rows.mapInArrow(_encoder(path, keep, counts), f"{kinds}, " + ("n_tokens bigint" if counts else "ids array<int>"))


def encode_column(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """keep..., ids: one row per row of df, whole texts, no special tokens; [] for empty and null texts. No shuffle."""
    return _run(df, text, list(keep), path, False)


def count_tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """keep..., n_tokens: the lengths of encode_column's lists."""
    return _run(df, text, list(keep), path, True)


def round_trip(df: DataFrame, text: str = "text", by: str = "source", path: str = VOCABULARY) -> DataFrame:
    """Per value of `by`: texts, tokens, and texts that decoding doesn't give back (none, for valid UTF-8)."""

    def run(batches):
        encode = transducer(path).encode
        for b in batches:
            ids = [encode(x) for x in b["_text"].to_pylist()]
            bad = [int(decode(i, path) != (x or "")) for i, x in zip(ids, b["_text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["g"], pa.array(map(len, ids), pa.int64()), pa.array(bad, pa.int64())], names=["g", "n", "bad"])

    rows = df.select(F.col(by).alias("g"), F.col(text).alias("_text")).mapInArrow(run, "g string, n bigint, bad bigint")
    return rows.groupBy("g").agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_tokens"), F.sum("bad").alias("n_changed")).withColumnRenamed("g", by)
