"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes of a text cuts it into chunks whose borders
depend on nearby content only, so a passage shared by documents gives the same
chunks in each. A chunk's inner part (from its first to its last white space)
is encoded once a worker and kept in a bounded cache; what a border cuts
through is repaired: the words left open on both sides of each join are put
together, across as many chunks as have no white space at all, and
encoded anew. White space is where the tokenizer always starts afresh, so the
repaired ids agree with those of the whole text.

The chunk cache is a worker's own: sharing encoded chunks through a shuffle
would move more bytes (ids and texts) than encoding again costs.

Defined cases: null text is empty (0 tokens, hashes of the empty string);
repeated rows and null ids give one row each; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common, words

#: Bytes in the rolling window, mean chunk length (a power of two), and bytes of chunks kept by a worker.
WINDOW, MEAN_CHUNK, CACHE_BYTES = 16, 1024, 8 << 20
_MIX = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
SPACES = " \t\n\r\x0b\x0c"


def chunk_ends(data: bytes, window: int = WINDOW, mean: int = MEAN_CHUNK) -> list[int]:
    """Ends of the content-defined chunks of UTF-8 ``data``; never inside a character.

    Rolling (cyclic polynomial) hash of each ``window`` bytes, in log2(window) doublings.
    """
    n = len(data)
    if n <= window:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h, width = _MIX[raw], 1
    while width < window:
        r = width % 32
        turned = (h[:-width] << np.uint32(r)) | (h[:-width] >> np.uint32(32 - r))
        h, width = turned ^ h[width:], width * 2
    cut = np.flatnonzero((h & np.uint32(mean - 1)) == 0) + width
    cut = cut[cut < n]
    cut = cut[(raw[cut] & 0xC0) != 0x80]
    return [*cut.tolist(), n]


class Chunks:
    """Encodes whole texts by chunks kept in a bounded cache."""

    def __init__(self, path: str):
        self.enc = words.encoder(path)
        vocab = self.enc.tokenizer.get_vocab(with_added_tokens=True)
        name = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            name[i] = token
        self.names = name
        self.words = words.Bounded(self.word, words.CACHE_WORDS // 2)
        self.chunks: dict[bytes, tuple] = {}
        self.held = 0

    def word(self, word: str) -> tuple[bytes, str]:
        return self.named(self.enc.word(word))

    def named(self, ids: bytes) -> tuple[bytes, str]:
        return ids, " ".join([self.names[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)])

    def run(self, text: str) -> tuple[bytes, str]:
        """Ids and decoded form of a text that begins and ends at white space."""
        got = [self.words[w] for w in text.split()]
        return b"".join([x[0] for x in got]), " ".join([x[1] for x in got])

    def chunk(self, data: bytes) -> tuple:
        """(open words at the start, ids, decoded, open words at the end); ids None: no white space inside."""
        found = self.chunks.get(data)
        if found is None:
            text = data.decode()
            first = next((i for i, c in enumerate(text) if c in SPACES), -1)
            if first < 0:
                found = (text, None, "", "")
            else:
                last = max(map(text.rfind, SPACES))
                found = (text[:first], *self.run(text[first:last]), text[last + 1:])
            if self.held + len(data) > CACHE_BYTES:
                self.chunks.clear()
                self.held = 0
            self.chunks[data] = found
            self.held += len(data)
        return found

    def text(self, text: str) -> tuple[bytes, str]:
        """Ids as bytes and decoded text, both equal to the library's."""
        if words.ODD_SPACE.search(text):
            return self.named(self.enc.whole(text))
        data, start, ids, decoded, open_words = text.encode(), 0, [], [], ""
        for end in chunk_ends(data):
            head, inner, inner_decoded, tail = self.chunk(data[start:end])
            start = end
            open_words += head
            if inner is None:
                continue
            for part_ids, part in (self.run(open_words), (inner, inner_decoded)):
                if part_ids:
                    ids.append(part_ids)
                    decoded.append(part)
            open_words = tail
        part_ids, part = self.run(open_words)
        if part_ids:
            ids.append(part_ids)
            decoded.append(part)
        return b"".join(ids), " ".join(decoded)


@words.worker_cache("tokens")
def chunks(path: str) -> Chunks:
    return Chunks(path)


def encode(docs: DataFrame, path: str | None = None, outputs: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256
    (``outputs``: also ids, as bytes of 32-bit integers, and the decoded text)."""
    path = path or words.tokenizer_path()

    def rows(batches):
        enc = chunks(path)
        for batch in batches:
            got = [enc.text(t) for t in batch.column(1).to_pylist()]
            out = {"doc_id": batch.column(0), "n_tokens": pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                   "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i, _ in got], pa.string()),
                   "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in got], pa.string())}
            if outputs:
                out |= {"ids": pa.array([i for i, _ in got], pa.binary()), "decoded": pa.array([d for _, d in got], pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    more = ", ids binary, decoded string" if outputs else ""
    return (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
            .mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(common.documents(spark, sf_dir))
