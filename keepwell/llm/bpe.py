"""Byte-level BPE: texts to ids and back, with the tiktoken library and a local rank file.

The library splits a text by a pattern and merges each match apart. Of long texts it is
given segments: a text is cut only where every match of the pattern must end, whatever
stands around it, so the ids of the segments one after another are those of the text.
Such a place is

* behind a character that is not white space and before white space: a match holds white
  space only at its begin or throughout, and the pattern looks ahead only from white space;
* behind a letter or digit and before punctuation, for scripts that write no blanks.

A stretch without such a place (a run of a million blanks, say) goes to the library one
match at a time; its own splitter ends the process on some of them. Ids are turned back
into the bytes of their tokens, so a token that ends within a character does no harm.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from keepwell.llm.common import ship, text_of
from keepwell.llm.tokens import public

#: Characters after which a long text is cut at the next safe place.
SEGMENT = 1 << 16
#: Bytes of results after which a batch is handed on.
BATCH_BYTES = 16 << 20
#: A character after which a match ends: white space follows, or punctuation behind a letter
#: or digit. Classes of the second kind are spelt out, so that no Unicode version matters.
_SAFE = regex.compile(r"\S(?=\s)|[0-9A-Za-zぁ-ゖァ-ヺ一-龥가-힣]"
                      r"(?=[!-/:-@\[-`{-~、。！，？])")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """``text`` in parts of ``size`` characters and what lies before the next safe place."""
    start = 0
    while len(text) - start > size and (found := _SAFE.search(text, start + size - 1)):
        yield text[start:found.end()]
        start = found.end()
    yield text[start:]


class Bpe:
    """A rank file's vocabulary; ``pattern`` splits texts before the merges."""

    def __init__(self, path: str, pattern: str | None = None, segment: int = SEGMENT):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        pattern, self.highest = pattern or public_tokenizers.PATTERN, max(ranks.values())
        self._size, self._matches = segment, regex.compile(pattern)
        self._texts = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._match = tiktoken.Encoding("match", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers; strings of special tokens are text."""
        found = [np.zeros(0, "<u4")]
        for part in segments(text, self._size):
            if len(part) <= 2 * self._size:
                found.append(self._texts.encode_to_numpy(part, disallowed_special=()))
            else:
                found += [self._match.encode_to_numpy(m[0], disallowed_special=()) for m in self._matches.finditer(part)]
        return np.concatenate(found).astype("<u4", copy=False)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens one after another; an unknown id is an error."""
        return self._texts.decode_bytes(ids.tolist())


@functools.lru_cache(maxsize=4)
def loaded(path: str) -> Bpe:
    """The vocabulary at ``path``, once per worker process."""
    return Bpe(path)


def _encode(batches: Iterable[pa.RecordBatch], vocab: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bpe, first, size = loaded(vocab), 0, 0
        counts, ids = [], []

        def done(until: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0).slice(first, until - first), pa.array(counts, pa.int64()),
                                               pa.array(ids, pa.binary())], names=["id", "n_tokens", "ids"])

        for i, text in enumerate(batch.column(1)):
            found = bpe.encode(text.as_buffer().to_pybytes().decode("utf-8", "replace"))
            counts.append(len(found)), ids.append(found.tobytes())
            size += len(ids[-1])
            if size > BATCH_BYTES:
                yield done(i + 1)
                first, size, counts, ids = i + 1, 0, [], []
        if counts:
            yield done(batch.num_rows)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_tokens`` (long) and ``ids`` (binary: the ids of the
    whole text as little-endian unsigned 32-bit integers).

    Null texts count as empty and have no ids; null and repeated ids of rows are kept as they
    are; bytes that are not UTF-8 count as U+FFFD. Other columns are ignored, whatever their
    names; an empty table gives no rows. ``vocab`` is the path of a rank file that every
    executor has (the public multi-language one if none is given). Memory is bounded by a
    batch of texts, time by their length.
    """
    if id_col in ("n_tokens", "ids"):
        raise ValueError(f"the id column may not be named like a result: {id_col}")
    ship(docs.sparkSession)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("n_tokens", LongType()),
                         StructField("ids", BinaryType())])
    return (docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").cast("binary").alias("t"))
            .mapInArrow(partial(_encode, vocab=vocab or public("byte_bpe_multi_50k.tiktoken")), schema)
            .withColumnRenamed("id", id_col))


def _decode(batches: Iterable[pa.RecordBatch], vocab: str, at: int, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bpe, first, size, data = loaded(vocab), 0, 0, []

        def done(until: int) -> pa.RecordBatch:
            own = batch.slice(first, until - first)
            return pa.RecordBatch.from_arrays([*own.columns, pa.array(data, pa.binary())], names=[*own.schema.names, name])

        for i, ids in enumerate(batch.column(at)):
            raw = ids.as_py() or b""
            if len(raw) % 4:
                raise ValueError(f"ids take 4 bytes each, a row has {len(raw)} bytes")
            data.append(bpe.decode(np.frombuffer(raw, "<u4")))
            size += len(data[-1])
            if size > BATCH_BYTES:
                yield done(i + 1)
                first, size, data = i + 1, 0, []
        if data:
            yield done(batch.num_rows)


def decode(encoded: DataFrame, ids_col: str = "ids", data_col: str = "data", vocab: str | None = None) -> DataFrame:
    """``encoded`` (all columns) with ``data_col``: the bytes that the ids of ``ids_col`` stand
    for, as ``encode`` gives them. Null ids count as none. An id that the vocabulary does not
    have, or a part of an id, ends the job with an error. An empty table gives no rows."""
    if data_col.lower() in {c.lower() for c in encoded.columns}:
        raise ValueError(f"there is a column {data_col} already")
    ship(encoded.sparkSession)
    schema = StructType([*encoded.schema.fields, StructField(data_col, BinaryType())])
    return encoded.mapInArrow(partial(_decode, vocab=vocab or public("byte_bpe_multi_50k.tiktoken"),
                                      at=encoded.columns.index(ids_col), name=data_col), schema)
