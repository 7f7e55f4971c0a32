"""Chunk embeddings and vector records.

The reference calls a hosted embedding model per chunk. The default here is a
feature-hashing embedder: every token (T9 pattern) goes to bucket
``int(md5(token)[:8], 16) % dim``, the vector holds bucket counts,
L2-normalised, as float32. Tokens are found JVM-side; an Arrow UDF hashes the distinct ones of
a batch and takes one ``bincount`` + normalise for every 256 chunks. A chunk with no
token cannot be embedded (a hosted model rejects empty input) and gets a null
embedding, counted as an embedding error.

Any other embedder is a ``Column -> Column`` callable returning
``array<float>`` (null on failure); mark a paid one ``asNondeterministic()``
and write its output once, so task retries do not pay twice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.functions.keys import index_name, vector_key
from lexcurate.functions.text import TOKEN_PATTERN

DEFAULT_DIM = 1536
# chunks whose counts are held at once: 256 vectors of 1536 numbers are 3 MB
CHUNKS_AT_ONCE = 256


def tokens(text, pattern: str = TOKEN_PATTERN) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), 0)


def token_buckets(text, dim: int, pattern: str = TOKEN_PATTERN) -> Column:
    return F.transform(tokens(text, pattern), lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long")
                                                         % F.lit(dim)).cast("int"))


def _bincount_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def normalized_counts(tokens: pa.Array) -> pa.Array:
        words = tokens.flatten().dictionary_encode()  # a digest for each distinct token of a batch, not for each token
        digests = (hashlib.md5(w.encode(), usedforsecurity=False).digest() for w in words.dictionary.to_pylist())
        bucket = np.array([int.from_bytes(d[:4], "big") % dim for d in digests], np.int64)[words.indices.to_numpy()]
        n = tokens.value_lengths().fill_null(0).to_numpy()
        end = np.cumsum(n)
        units = [np.zeros(0, np.float32)]
        for at in range(0, len(n), CHUNKS_AT_ONCE):
            size = n[at:at + CHUNKS_AT_ONCE]
            cells = bucket[end[at] - n[at]:end[at + len(size) - 1]] + np.repeat(np.arange(len(size)), size) * dim
            counts = np.bincount(cells, minlength=len(size) * dim).reshape(-1, dim)[size > 0].astype(np.float64)
            units.append((counts / np.sqrt((counts * counts).sum(1))[:, None]).astype(np.float32).ravel())
        offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, dim, 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(units)), mask=pa.array(n == 0))

    return normalized_counts


def hashing_embedder(dim: int = DEFAULT_DIM):
    """``Column -> Column`` embedder: array<float> of width ``dim`` or null."""
    # nondeterministic: evaluated once per row and never duplicated into a
    # pushed-down filter (the contract a paid embedder needs too)
    udf = _bincount_udf(dim).asNondeterministic()
    return lambda text: udf(tokens(text))


def vector_records(chunks: DataFrame, embedder, *, court_col: str = "court", cnr_col: str = "cnr",
                   title_col: str = "title", year_col: str = "run_year", chunk_id_col: str = "chunk_id",
                   content_col: str = "content") -> DataFrame:
    """P6 + P10 + J2: one vector record per embedded chunk.

    Input rows already carry the document's cnr / title / year (the chunks
    were exploded from the document row, so no join is needed). Output:
    index_name, key, data, metadata struct, plus ``embedded`` flag.
    """
    emb = embedder(F.col(content_col))
    return chunks.select(
        index_name(F.col(court_col)).alias("index_name"),
        vector_key(F.col(cnr_col), F.col(chunk_id_col)).alias("key"),
        emb.alias("data"),
        F.struct(F.col(cnr_col).alias("cnr"), F.col(content_col).alias("content"),
                 F.col(title_col).alias("title"), F.col(year_col).alias("year")).alias("metadata"),
        *[c for c in chunks.columns if c not in (content_col,)],
    )
