"""Document fingerprints by a homomorphic multiset hash.

A paragraph (a line of the text) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors: EXACT lanes modulo 2**64, taken
from a cryptographic hash of the paragraph, and LIKE lanes modulo 2**32, in which
each short run of the paragraph's words adds +1 or -1. Addition commutes, so the
order of paragraphs doesn't matter, and a paragraph is inserted or deleted by adding
or subtracting its vector. The exact lanes decide equality. The like lanes, read as
signed numbers, are a random projection of the counts of all runs, so that the
cosine of two of them estimates how much of the texts is shared. Runs end at words
chosen by their own hash, hence an edit changes only the runs around it.

Edge cases: a null or empty text has no paragraph and the zero vector; empty lines
are paragraphs; two zero vectors are alike (1), a zero and another vector are not
(0). Texts of any length are handled in blocks. Documents with equal ids are
ordered by their texts, a null id or one that is no whole number comes last, and an only document follows itself.
An empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haatlake.llm.common import BLOCK_CHARS, spare, text_blocks
from haatlake.llm.hashing import mix, word_hashes

EXACT, LIKE = 8, 256
# A word ends its run with a chance of one in RUN.
RUN = 4
# Paragraphs hashed at a time.
PARAGRAPHS = 100_000
# Bytes of stored input for a range of documents that one task pairs with their neighbours; smaller
# ranges, of at least so many bytes, where that gives each core some.
RANGE_BYTES, LEAST_BYTES = 128 << 20, 8 << 20
LOWEST = -(2**63)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The exact lanes and the like lanes of each text."""
    exact, like = np.zeros((len(texts), EXACT), np.uint64), np.zeros((len(texts), LIKE), np.int32)
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    for i, raw in enumerate(raws):
        at = 0
        while raw and at >= 0:  # some paragraphs at a time
            parts = raw[at:].split(b"\n", PARAGRAPHS) if at or len(raw) > PARAGRAPHS else raw.split(b"\n")
            at = len(raw) - len(parts.pop()) if len(parts) > PARAGRAPHS else -1
            digests = b"".join([hashlib.blake2b(p).digest() for p in parts])
            exact[i] += np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(0, dtype=np.uint64)
    joined = np.frombuffer(b"\n".join(raws), np.uint8)
    starts, _, words = word_hashes(joined)
    if not words.size:
        return exact, like
    text_end = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    line = np.cumsum(joined == 0x0A)[starts]
    first = np.r_[True, (line[1:] != line[:-1]) | (words[:-1] % np.uint64(RUN) == 0)]
    begin = np.flatnonzero(first)
    place = (np.arange(words.size) - np.repeat(begin, np.diff(np.r_[begin, words.size]))).astype(np.uint64)
    run = mix(np.add.reduceat(mix(words + place * np.uint64(0x9E3779B97F4A7C15)), begin))
    owner = np.searchsorted(text_end, starts[begin], "right")
    for at in range(0, run.size, 1 << 14):  # the bits of a run are its row of signs
        part, who = run[at : at + (1 << 14)], owner[at : at + (1 << 14)]
        bits = np.stack([mix(part + np.uint64(k * 0xD6E8FEB86659FD93 % 2**64)) for k in range(LIKE // 64)], 1)
        signs = np.unpackbits(bits.view(np.uint8), axis=1)
        here = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        ones = np.add.reduceat(signs, here, axis=0, dtype=np.int32)
        like[who[here]] += 2 * ones - np.diff(np.r_[here, who.size])[:, None].astype(np.int32)
    return exact, like


def shown(exact: np.ndarray, like: np.ndarray) -> str:
    """A fingerprint as base64 text: the exact lanes, then the like lanes."""
    return base64.b64encode(exact.astype("<u8").tobytes() + like.astype("<i4").tobytes()).decode()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: 8 * EXACT], "<u8"), np.frombuffer(raw[8 * EXACT :], "<i4")


def changed(fingerprint: str, insert: list[str] = [], delete: list[str] = []) -> str:
    """The fingerprint after paragraphs are inserted and deleted, without the document."""
    exact, like = read(fingerprint)
    for sign, paragraphs in ((1, insert), (-1, delete)):
        for p in paragraphs:
            e, x = vectors([p])
            if not p:  # an empty paragraph of a document with others
                e = np.frombuffer(hashlib.blake2b(b"").digest(), "<u8")[None, :]
            exact = exact + e[0] if sign > 0 else exact - e[0]
            like = like + np.int32(sign) * x[0]
    return shown(exact, like)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """From 0 to 1, row by row; 1 exactly for equal fingerprints."""
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where((a[0] == b[0]).all(1), 1.0, np.clip(cosine, 0, 1))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add each row's fingerprint. No shuffle."""
    kept, hidden = [c for c in df.columns if c != out], spare(df, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, hidden):
            made = pa.array([shown(e, x) for e, x in zip(*vectors(texts))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [made], [*kept, out])

    schema = df.select(*kept, F.lit("").alias(out)).schema
    return df.select(*kept, df[text].alias(hidden)).mapInArrow(run, schema)


def _ranges(ids: DataFrame, n: int) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Upper ends of at most n ranges of ids, and for each range's highest id the range that needs it as a neighbour.

    Spark deals the ids alone by ranges; a row for each range comes to the driver, and with each task.
    """
    ranged = ids.repartitionByRange(n, "id").groupBy(F.spark_partition_id().alias("range")).agg(F.max("id").alias("top"))
    tops = np.unique(np.array([r.top for r in ranged.collect()], np.int64))  # ids that are equal lie in one range
    needed: dict[int, list[int]] = {}
    for k, top in enumerate(tops.tolist()):  # the range above, or the first document's follower: that of the last one
        needed.setdefault(top, []).append((k + 1) % len(tops))
    return tops[:-1], needed


def _range_count(df: DataFrame) -> int:
    from haatlake.plans.session import input_bytes

    size, cores = input_bytes(df), df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // RANGE_BYTES), min(-(-size // LEAST_BYTES), 16 * cores))


def compare_edited(df: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Each document against an edited text and against the next document in descending doc_id.

    The edited text's last third is the next document's beginning. Documents are dealt
    by ranges of ids, each with a copy of the first document of the range below.
    """
    n = ranges or _range_count(df)
    docs = df.select(F.coalesce(df[doc_id].try_cast("long"), F.lit(LOWEST)).alias("id"), df[doc_id].alias("doc_id"), df[text].alias("text"))
    ends, needed = _ranges(docs.select("id"), n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        names = ["range", "guest", "id", "doc_id", "text"]
        for batch, texts in text_blocks(batches, "text"):
            ids = batch.column("id").to_numpy()
            found = np.searchsorted(ends, ids)
            small = [press.compress(t.encode("utf-8", "surrogatepass")) for t in texts]
            rows = [(r, False, i, k) for k, (r, i) in enumerate(zip(found.tolist(), ids.tolist()))]
            rows += [(r, True, i, k) for k, i in enumerate(ids.tolist()) if i in needed for r in needed[i]]
            r, guest, i, k = zip(*rows)
            take = pa.array(k, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, pa.int64()), pa.array(guest, pa.bool_()), pa.array(i, pa.int64()), batch.column("doc_id").take(take),
                 pa.array(small, pa.binary()).take(take)], names)

    kind = df.schema[doc_id].dataType.simpleString()
    dealt = (docs.mapInArrow(deal, f"range long, guest boolean, id long, doc_id {kind}, text binary")
             .repartition(n, "range").sortWithinPartitions("range", "guest", F.desc("id"), "text"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, object, str]]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                raw = unpress.decompress(batch.column("text")[k].as_py())
                yield batch.column("range")[k].as_py(), batch.column("guest")[k].as_py(), batch.column("doc_id")[k].as_py(), raw.decode("utf-8", "surrogatepass")

    def results(ids: list, texts: list[str], follower: str) -> pa.RecordBatch:
        after = [*texts[1:], follower]
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, after)]
        own, other = vectors([*texts, follower]), vectors(edited)
        these, those = tuple(v[:-1] for v in own), tuple(v[1:] for v in own)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, ids_type), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array([shown(e, x) for e, x in zip(*these)], pa.string()), pa.array([shown(e, x) for e, x in zip(*other)], pa.string()),
            pa.array(likeness(these, other)), pa.array(likeness(these, those)),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    from pyspark.sql.pandas.types import to_arrow_type

    ids_type = to_arrow_type(df.schema[doc_id].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, texts, size, over = None, [], [], 0, False
        for r, guest, i, t in rows_of(batches):
            if r != at:
                at, over = r, False
            elif over:  # further copies of the guest's id
                continue
            if guest or size >= BLOCK_CHARS:
                yield results(ids, texts, t)
                ids, texts, size, over = [], [], 0, guest
            if not guest:
                ids.append(i)
                texts.append(t)
                size += len(t)

    return dealt.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")
