"""Token counts of texts by a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary is by default; only the driver reads it and sends it along (about 1 MB).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the public byte-level vocabularies cut text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A text is encoded in stretches of at most so many characters, cut before white space: merging is slow on endless words.
STRETCH = 100_000


@lru_cache(2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("quire", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _length(encoding, text: str) -> int:
    total, at = 0, 0
    while len(text) - at > STRETCH:
        cut = text.rfind(" ", at + 1, at + STRETCH)
        cut = cut if cut > 0 else at + STRETCH
        total += len(encoding.encode_ordinary(text[at:cut]))
        at = cut
    return total + len(encoding.encode_ordinary(text[at:]))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, heads: bool = False) -> DataFrame:
    """``doc_id, source, digest, n_tokens`` of every text that isn't null or empty; the digest has 128 bits.

    With ``heads`` also ``head_tokens``, those of the first line of a text that has several, else 0.
    """
    raw = Path(vocabulary).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(raw)
        for b in batches:
            texts = [t.as_py() for t in b.column("text")]
            sizes = pa.array([_length(encoding, t) for t in texts], pa.int64())
            digests = pa.array([blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts], pa.binary())
            columns = [b.column("doc_id"), b.column("source"), digests, sizes]
            if heads:
                columns.append(pa.array([_length(encoding, t.lstrip()[: t.lstrip().find("\n") + 1]) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "digest", "n_tokens", "head_tokens"][: len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").where("text <> ''")
    return rows.mapInArrow(run, "doc_id long, source string, digest binary, n_tokens long" + ", head_tokens long" * heads)
