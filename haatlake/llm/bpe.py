"""Byte-pair encoding and decoding by forced-boundary splitting.

A merge can only join what some vocabulary token contains. A pair of neighbouring
bytes that occurs inside no token therefore always stays apart: it is a certain
cut. Each word is cut there, the fragments are encoded independently, and their
ids are concatenated. All fragments of a block of new words are merged together,
one numpy pass for each round of merges; words seen before come
from a table keyed by a 64-bit hash.

Edge cases: a null or empty text has no ids and decodes to ''. Special tokens in
a text are kept as their ids. Texts of any length and repeated rows are encoded
row by row; an empty table gives an empty table. Columns of the input pass
through unless an output has the same name, which then replaces it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from haatlake.llm.common import per_worker, spare, text_blocks
from haatlake.llm.hashing import Lookup, word_hashes

# Words of a worker's table, at a quarter of its slots; beyond it the table starts anew.
WORD_BITS = 21
WORDS = 1 << (WORD_BITS - 2)
# Fragments longer than this are merged with a heap, in n log n.
LONG = 512
# White space beyond ASCII, and a code point that valid text can't hold, which marks special tokens.
WIDE_SPACE = regex.compile(r"[^\S\x00-\x7f]")
MARK = "\ud800"
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class Encoder:
    """A byte-level BPE with word ends, from the JSON of a tokenizer file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(len(self.tokens))]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + self.end] for c in letters], np.int32)
        self._cuts(vocab, {c: b for b, c in enumerate(letters)})
        self._merges(model["merges"], vocab)
        self._forget()

    def _cuts(self, vocab: dict[str, int], byte_of: dict[str, int]) -> None:
        """joined[a, b]: byte b follows byte a inside some token; b + 256 where it ends the word."""
        self.joined = np.zeros((256, 512), bool)
        for token in vocab:
            whole = token.removesuffix(self.end) if self.end else token
            symbols = [byte_of[c] for c in whole]
            if len(whole) < len(token) and symbols:
                symbols[-1] += 256
            for a, b in zip(symbols, symbols[1:]):
                self.joined[a, b] = True

    def _merges(self, merges: list, vocab: dict[str, int]) -> None:
        """An open-addressing table from a pair of ids to its rank, read by numpy."""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.bits = max(4, len(pairs).bit_length() + 2)
        keys, ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        for (a, b), r in self.rank.items():
            slot = int(self._slot(np.array([(a << 32) | b]))[0])
            while keys[slot] != -1:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            keys[slot], ranks[slot] = (a << 32) | b, r
        self.keys, self.ranks = keys, ranks

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ (key >> 29)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.ranks[slot], NONE)
        todo = np.flatnonzero((there != key) & (there != -1))
        while todo.size:
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            found = there == key[todo]
            out[todo[found]] = self.ranks[slot[todo[found]]]
            todo = todo[~found & (there != -1)]
        return out

    def _fragments(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First symbols of all words, the fragment of each, and where each word begins."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(words), np.uint8)
        last = np.zeros(raw.size, bool)
        last[begin + size - 1] = True
        first = np.zeros(raw.size, bool)
        first[begin] = True
        first[1:] |= ~self.joined[raw[:-1], raw[1:] + (last[1:] * np.uint16(256))]
        return np.where(last, self.final[raw], self.inner[raw]), np.cumsum(first) - 1, begin

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each non-empty word, as little-endian 32-bit numbers."""
        if not words:
            return []
        symbol, fragment, begin = self._fragments(words)
        ids = np.full(symbol.size, -1, np.int32)
        place = np.arange(symbol.size)
        lengths = np.bincount(fragment)
        if lengths.max() > LONG:
            starts = np.cumsum(lengths) - lengths
            for f in np.flatnonzero(lengths > LONG):
                at = slice(starts[f], starts[f] + lengths[f])
                merged = self._heap(symbol[at].tolist())
                ids[starts[f] : starts[f] + len(merged)] = merged
            keep = lengths[fragment] <= LONG
            symbol, fragment, place = symbol[keep], fragment[keep], place[keep]
        while symbol.size:
            rank = np.full(symbol.size, NONE, np.int32)
            inside = np.flatnonzero(fragment[:-1] == fragment[1:])
            rank[inside] = self._ranks(symbol[inside], symbol[inside + 1])
            starts = np.flatnonzero(np.r_[True, fragment[1:] != fragment[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, symbol.size]))
            done = best == NONE
            ids[place[done]] = symbol[done]
            hit = (rank == best) & ~done
            run = np.flatnonzero(hit)
            if run.size > 1:  # of pairs that overlap, as in aaa, every second one merges
                new = np.r_[True, np.diff(run) > 1]
                head = np.maximum.accumulate(np.where(new, np.arange(run.size), 0))
                run = run[(np.arange(run.size) - head) % 2 == 0]
            symbol[run] = self.made[rank[run]]
            keep = ~done
            keep[run + 1] = False
            symbol, fragment, place = symbol[keep], fragment[keep], place[keep]
        kept = ids >= 0
        count = np.add.reduceat(kept, begin, dtype=np.int64)
        flat, end = ids[kept].astype("<u4").tobytes(), 4 * np.cumsum(count)
        return [flat[e - 4 * n : e] for e, n in zip(end.tolist(), count.tolist())]

    def _heap(self, symbols: list[int]) -> list[int]:
        """Merges of one long fragment: a linked list and a heap of (rank, place)."""
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap = [(r, i) for i in range(len(symbols) - 1) if (r := self.rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] < 0 or self.rank.get((symbols[i], symbols[j])) != r:
                continue
            symbols[i], symbols[j], after[i] = int(self.made[r]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (s := self.rank.get((symbols[a], symbols[after[a]]))) is not None:
                    heapq.heappush(heap, (s, a))
        return [s for s in symbols if s >= 0]

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of new white-space separated, normalised chunks to the pool."""
        words, owners, parts = [], [], [b""] * len(chunks)
        for i, chunk in enumerate(chunks):
            if chunk[0] == MARK:
                parts[i] = np.array([self.special[chunk[1:]]], "<u4").tobytes()
                continue
            for word in (chunk,) if chunk.isalpha() else self.words(chunk):
                words.append(word.encode())
                owners.append(i)
        for i, ids in zip(owners, self.encode_words(words)):
            parts[i] += ids
        made = np.frombuffer(b"".join(parts), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        n, m = self.known.size, self.used
        while m + made.size > self.pool.size:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[m : m + made.size] = made
        self.offset[n : n + size.size], self.length[n : n + size.size] = m + np.cumsum(size) - size, size
        self.used += made.size

    def _forget(self) -> None:
        """An empty table of words: hashes, and for each its ids in a pool."""
        self.known, self.used = Lookup(WORD_BITS), 0
        self.pool = np.zeros(1 << 16, "<u4")
        self.offset, self.length = np.zeros(WORDS, np.int64), np.zeros(WORDS, np.int32)

    def _normal(self, text: str) -> str:
        """Normalised and lower-case, words apart by ASCII white space."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # letters are lowered one by one: no final form
            text = text.replace("Σ", "σ")
        text = text.lower()
        return WIDE_SPACE.sub(" ", text) if WIDE_SPACE.search(text) else text

    def _marked(self, text: str) -> str:
        """The same with each special token as a chunk of its own."""
        parts, at = [], 0
        for m in self.specials.finditer(text):
            parts += [self._normal(text[at : m.start()]), MARK + m[0]]
            at = m.end()
        return " ".join([*parts, self._normal(text[at:])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        parts = [(self._marked(t) if "<" in t and self.specials.search(t) else self._normal(t)).encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b"\n".join(parts), np.uint8)
        starts, ends, hashes = word_hashes(raw)
        which = self.known.find(hashes)
        new = np.flatnonzero(which < 0)
        if new.size:
            keys, first = np.unique(hashes[new], return_index=True)
            if self.known.size + keys.size > WORDS:
                self._forget()
                keys, first = np.unique(hashes, return_index=True)
                new = np.arange(hashes.size)
                if keys.size > WORDS:
                    return self._halves(texts)
            first = new[first]
            view = raw.tobytes()
            self._learn([view[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            self.known.add(keys)
            which[new] = self.known.find(hashes[new])
        length = self.length[which]
        last = np.cumsum(length)
        at = np.repeat(self.offset[which] - last + length, length) + np.arange(last[-1] if last.size else 0)
        text_ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        words_before = np.searchsorted(starts, text_ends)
        return self.pool[at], np.r_[0, last][words_before]

    def _halves(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """More new words than the table holds: by halves of the texts, or of one text at white space."""
        if len(texts) > 1:
            half = len(texts) // 2
            (a, x), (b, y) = self.encode(texts[:half]), self.encode(texts[half:])
            return np.concatenate([a, b]), np.r_[x, y + a.size]
        cut = next(m.start() for m in regex.finditer(r"\s", texts[0], pos=len(texts[0]) // 2))
        ids, ends = self._halves([texts[0][:cut], texts[0][cut:]])
        return ids, ends[-1:]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special ones included, as the file without a decoder asks."""
        return " ".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[str, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    """The worker's encoder for this tokenizer file."""
    return per_worker(_ENCODERS, hashlib.blake2b(content).hexdigest(), lambda: Encoder(content))


def tokenizer_file(path: str | None = None) -> bytes:
    """The content of a tokenizer file; by default the public one with 49,000 words."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        return f.read()


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# What encode() can return: the type, and the value from an encoder and a text's ids.
OUTPUTS = {
    "ids": (T.ArrayType(T.IntegerType()), lambda e, ids: ids),
    "decoded": (T.StringType(), lambda e, ids: e.decode(ids)),
    "n_tokens": (T.LongType(), lambda e, ids: len(ids)),
    "ids_sha256": (T.StringType(), lambda e, ids: _sha(" ".join(map(e.numbers.__getitem__, ids)))),
    "decoded_sha256": (T.StringType(), lambda e, ids: _sha(e.decode(ids))),
}


def encode(df: DataFrame, text: str = "text", outputs: tuple[str, ...] = ("ids",), path: str | None = None,
           keep: tuple[str, ...] | None = None) -> DataFrame:
    """Add the outputs for each row's text. keep: the input columns to pass on (default: all)."""
    file = df.sparkSession.sparkContext.broadcast(tokenizer_file(path))
    kept, hidden = [c for c in (df.columns if keep is None else keep) if c not in outputs], spare(df, "_text")
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(o, OUTPUTS[o][0]) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(file.value)
        for batch, texts in text_blocks(batches, hidden):
            ids, ends = bpe.encode(texts)
            rows = [part.tolist() for part in np.split(ids, ends[:-1])]
            made = [pa.array([OUTPUTS[o][1](bpe, r) for r in rows], ARROW[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made, [*kept, *outputs])

    return df.select(*kept, df[text].alias(hidden)).mapInArrow(run, schema)


ARROW = {"ids": pa.list_(pa.int32()), "decoded": pa.string(), "n_tokens": pa.int64(), "ids_sha256": pa.string(),
         "decoded_sha256": pa.string()}


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text of each row's ids (null ids: '')."""
    file = df.sparkSession.sparkContext.broadcast(tokenizer_file(path))
    kept, hidden = [c for c in df.columns if c != out], spare(df, "_ids")
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(file.value)
        for batch in batches:
            texts = pa.array([bpe.decode(r or []) for r in batch.column(hidden).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [texts], [*kept, out])

    return df.select(*kept, df[ids].alias(hidden)).mapInArrow(run, schema)
