"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before the regular expression sees them, at places where no match of
the pattern can span: in front of white space that follows a character that is no white
space (every alternative either starts with its only space or is white space throughout).
So the parts' ids, joined, are the whole text's ids. Ids are decoded from raw bytes, token
by token, so partial UTF-8 inside a token does no harm.

Defined cases: null text is the empty text (no ids); special-token strings are ordinary
text; equal rows give equal results; an empty table gives no rows; other columns are
ignored. Rows are handled one by one in their own partition, with no shuffle, so a lost
executor costs its partitions only.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from cinderspark.llm import shared

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Texts above this many characters are cut, into parts of about as many.
PART_CHARS = 16_384

_ENCODINGS: dict = {}
_SAFE = re.compile(r"(?<=\S)(?=\s)")


def encoding(path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
    """The tiktoken encoding of a rank file, made once in each process."""
    if (path, pattern) not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def parts(text: str, chars: int = PART_CHARS):
    """``text`` in order, cut only at safe boundaries, each part of ``chars`` or the least beyond."""
    start = 0
    while len(text) - start > chars:
        found = _SAFE.search(text, start + chars)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(text: str | None, path: str = RANKS) -> list[int]:
    if not text:
        return []
    ordinary = encoding(path).encode_ordinary
    if len(text) <= PART_CHARS:
        return ordinary(text)
    ids: list[int] = []
    for part in parts(text):
        ids.extend(ordinary(part))
    return ids


def decode(ids: list[int], path: str = RANKS) -> bytes:
    return encoding(path).decode_bytes(ids)


def encoded(documents: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, ids array<int> of every document."""

    def run(batches):
        for batch in batches:
            ids = [encode(text, path) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents.select("doc_id", documents["text"].cast("string")).mapInArrow(run, f"doc_id {_type(documents)}, ids array<int>")


def round_trip(documents: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes: digests of the ids and of the bytes decoded from them."""

    def run(batches):
        for batch in batches:
            counts, of_ids, of_bytes, sizes = [], [], [], []
            for text in batch.column(1):
                ids = encode(text.as_py(), path)
                back = decode(ids, path)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(back).hexdigest())
                sizes.append(len(back))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()), pa.array(sizes, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    return documents.select("doc_id", documents["text"].cast("string")).mapInArrow(
        run, f"doc_id {_type(documents)}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    )


def _type(documents: DataFrame) -> str:
    return dict(documents.dtypes)["doc_id"]


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the digests of every document that is left."""
    return round_trip(docs)


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(shared.read(spark, sf_dir, "documents"))
