"""Byte-pair encoding of whole texts with a word-end vocabulary, and decoding.

A word is merged on a contiguous rank array: the parts' ids lie in one list and
the rank of each adjacent pair in another; the smallest rank (leftmost on ties)
is found by a scan, its boundary deleted, and the two neighbouring ranks
refreshed.  Scanning is quadratic, so words of over ``LONG_WORD`` parts take
the same merges in the same order from a heap over a linked list.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.text import PIECE_BYTES, slices

LONG_WORD = 128
CACHE_WORDS = 50_000   # distinct words a Python worker remembers, also while it serves other operators
_NONE = 1 << 60        # rank of a pair that does not merge

# White space as the vocabulary's pattern means it (the Unicode White_Space property)
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
# Fixed pattern: contractions, letter runs, single digits, runs of other signs
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
# The same for texts below U+0250 without the signs on which the two libraries' classes differ
_ODD = re.compile("[^\x00-ɏ]|[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]")
_SIMPLE_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


@lru_cache(maxsize=1)
def _unassigned() -> tuple[re.Pattern, regex.Pattern, dict[int, str]]:
    """How to treat letters and digits that Python's Unicode tables do not know but ``regex`` does: what finds
    them, the word pattern for texts that hold one, and their lower case.

    Three versions of Unicode meet here, so the library is asked about each of these code points.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    known = regex.compile(r"[\p{L}\p{N}]")
    new = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    split = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed").pre_tokenize_str

    def ranges(chars: list[str]) -> str:
        at = [ord(c) for c in chars]
        first = [c for k, c in enumerate(at) if k == 0 or at[k - 1] != c - 1]
        last = [c for k, c in enumerate(at) if k == len(at) - 1 or at[k + 1] != c + 1]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last)) or "\\x00"   # a sign anyway

    signs = ranges([c for c in new if split(c)])
    word = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{signs}]]+|[\p{{N}}--[{signs}]]"
                         rf"|(?:[^{_SPACE}\p{{L}}\p{{N}}]|[{signs}])+")
    lower = normalizers.Lowercase().normalize_str
    return re.compile(f"[{ranges(new)}]"), word, {ord(c): lower(c) for c in new if lower(c) != c}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class _Words(dict):
    """word -> value, computed on first use and kept within a bound."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


class WordBpe:
    """Encoder and decoder for a vocabulary file of the ``tokenizers`` format: byte letters,
    word ends marked by a suffix, NFC and lower case, special strings kept whole."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (vocab | self.special).items()}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        pairs = spec["model"]["merges"]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.merged = [vocab[a + b] for a, b in pairs]  # id by rank
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.word_ids = _Words(lambda w: b"".join(i.to_bytes(4, "little") for i in self.merge(w)))
        self.word_text = _Words(lambda w: self.decode(memoryview(self.word_ids[w]).cast("I")))

    def merge(self, word: str) -> list[int]:
        """Token ids of one word."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self._scan(ids) if len(ids) <= LONG_WORD else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        rank, merged = self.rank.get, self.merged
        ranks = [rank(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            k = ranks.index(low)
            ids[k] = merged[low]
            del ids[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), _NONE)
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), _NONE)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        rank, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1)
                if (r := rank((ids[k], ids[k + 1]), _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            low, k, a, b = heapq.heappop(heap)
            m = after[k]
            if ids[k] != a or m >= n or ids[m] != b:
                continue  # one of the parts has merged meanwhile
            ids[k], ids[m] = self.merged[low], -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n:
                    x, y = ids[left], ids[after[left]]
                    if (r := rank((x, y), _NONE)) != _NONE:
                        heapq.heappush(heap, (r, left, x, y))
        return [i for i in ids if i >= 0]

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case knows no final sigma
        text = text.lower()
        if not _ODD.search(text):
            return _SIMPLE_WORD.findall(text)
        new, word, lower = _unassigned()
        return word.findall(text.translate(lower)) if new.search(text) else _WORD.findall(text)

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text that they decode to."""
        if not any(s in text for s in self.special):
            words = self.words(text)
            return b"".join(map(self.word_ids.__getitem__, words)), " ".join(map(self.word_text.__getitem__, words))
        ids, texts = [], []
        for part in self.split.split(text):
            if part in self.special:
                ids.append(self.special[part].to_bytes(4, "little"))
                texts.append(self.decode([self.special[part]]))
            elif words := self.words(part):
                ids += map(self.word_ids.__getitem__, words)
                texts += map(self.word_text.__getitem__, words)
        return b"".join(ids), " ".join(texts)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, special ones included; the vocabulary names no other decoder."""
        return " ".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One encoder per Python worker and vocabulary."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every whole text.

    ``docs`` needs doc_id and text; other columns are ignored.  One row per input
    row, in a narrow pass without a shuffle: doc_id, n_tokens, ids (binary:
    little-endian unsigned 32-bit integers) and decoded.  NULL and empty texts
    give no ids and an empty string; a NULL doc_id and repeated rows are kept.
    ``path`` must name the vocabulary file on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for part in slices(batches, max_bytes=PIECE_BYTES):
            ids, decoded = zip(*(bpe.encode_decode(t or "") for t in part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of the decoded text's UTF-8 bytes."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
