"""Chat formatting at token level.

A turn is ``<turn>`` role ``<text>`` text ``</turn>``. Role and text are encoded apart
and reserved ids are spliced between them, so no text can yield a control id, whatever
it says. Control strings inside texts are escaped as well, so that the decoded form is
unambiguous: every backslash is doubled and a backslash is put behind the first
character of a control string, which then no longer occurs; a backslash makes the next
character stand for itself.

Turns come in order through Spark's range partitioning, which cuts a long conversation into
several ranges, so none is one task. A range writes what it holds of a conversation in chunks
of at most ``chunk_tokens`` ids; only conversations at the edge of a range, two a range, need
their chunks numbered and closed across ranges. Chunks are read back each where it lies. Of
conversations of several chunks the bytes they say meet in order for the digest, which is one
sequence by definition; the others need no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, IntegerType, LongType, StringType, StructField,
                               StructType)

from keepwell.llm.bpe import Bpe, loaded
from keepwell.llm.common import ship, text_of, written
from keepwell.llm.tokens import public
from keepwell.scratch import settled

#: Reserved ids, past those of the vocabulary, and their form as text.
RESERVED = {50256: "<|endoftext|>", 50257: "<turn>", 50258: "<text>", 50259: "</turn>"}
END, OPEN, BODY, CLOSE = RESERVED
#: Strings that texts may not hold unescaped.
CONTROL = (*RESERVED.values(), "### System:", "### User:", "### Assistant:", "<|im_start|>", "<|im_end|>")
_ESCAPE = re.compile("|".join(["\\\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_UNESCAPE_BYTES = re.compile(rb"\\(.)", re.DOTALL)
#: Characters of a text by which equal turns are ordered, before its digest.
HEAD = 64


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def encode_turn(bpe: Bpe, role: str, text: str, learn: bool) -> tuple[np.ndarray, int, int]:
    """(ids, begin, end) of a turn: its learned segment, the text and nothing else, is ids[begin:end]."""
    shown = _few(bpe, role) if len(role) < HEAD else bpe.encode(escape(role))
    body = bpe.encode(escape(text))
    ids = np.empty(len(shown) + len(body) + 3, dtype=np.int32)
    begin = len(shown) + 2
    ids[0], ids[1:begin - 1], ids[begin - 1], ids[begin:-1], ids[-1] = OPEN, shown, BODY, body, CLOSE
    return ids, begin, begin + len(body) if learn else begin


@lru_cache(maxsize=1024)
def _few(bpe: Bpe, role: str) -> np.ndarray:
    return bpe.encode(escape(role))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    flat = np.concatenate([*rows, np.zeros(0, rows[0].dtype if rows else np.int32)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, kind))


def loss_mask(lengths: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A flag per id of turns that lie one after another: the prefix sum of +1 where a learned
    segment begins and -1 behind its end."""
    starts = np.cumsum(lengths) - lengths
    steps = np.zeros(int(lengths.sum()) + 1, dtype=np.int32)
    np.add.at(steps, starts + begins, 1)
    np.add.at(steps, starts + ends, -1)
    return np.cumsum(steps[:-1]) > 0


class _Chunks:
    """The chunks of what a range holds of conversations whose turns come in order. What is held is
    at most a chunk and a batch. The first conversation of a range may have begun in an earlier
    one and the last may go on in a later one: the last chunk here of either is marked ``edge``, and
    that of the last conversation, which has no end yet, has room for one more id."""

    def __init__(self, size: int, schema: pa.Schema):
        self.size, self.schema, self.conv, self.begun, self.nth, self.first = size, schema, None, False, 0, True
        self.ids: list[np.ndarray] = []
        self.loss: list[np.ndarray] = []
        self.out: list[tuple] = []

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        self.ids.append(ids), self.loss.append(loss)

    def _put(self, ids: np.ndarray, loss: np.ndarray, edge: bool = False, closed: bool = False) -> None:
        self.out.append((self.conv, self.nth, ids, loss, edge, closed))
        self.nth += 1

    def cut(self) -> None:
        """Hand on full chunks; at least one id stays."""
        ids, loss = np.concatenate(self.ids), np.concatenate(self.loss)
        whole = max(0, len(ids) - 1) // self.size * self.size
        for at in range(0, whole, self.size):
            self._put(ids[at:at + self.size], loss[at:at + self.size])
        self.ids, self.loss = [ids[whole:]], [loss[whole:]]

    def begin(self, conv) -> None:
        if self.begun:
            self.add(np.array([END], np.int32), np.zeros(1, bool))
            self.cut()
            self._put(self.ids[0], self.loss[0], self.first, True)
            self.first = False
        self.conv, self.begun, self.nth, self.ids, self.loss = conv, True, 0, [], []

    def stop(self) -> None:
        self.cut()
        ids, loss = self.ids[0], self.loss[0]
        if len(ids) == self.size > 1:
            self._put(ids[:-1], loss[:-1])
            ids, loss = ids[-1:], loss[-1:]
        self._put(ids, loss, True)

    def flush(self, place: int) -> pa.RecordBatch:
        keys, nths, ids, loss, edge, closed = (list(c) for c in zip(*self.out, strict=True))
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, self.schema.field(0).type), pa.array([place] * len(keys), pa.int32()), pa.array(nths, pa.int32()),
             _lists(ids, pa.int32()), _lists(loss, pa.bool_()), pa.array(edge), pa.array(closed)], schema=self.schema)


def _assemble(batches: Iterable[pa.RecordBatch], learn: str, vocab: str, chunk_tokens: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conv_id, place, role, text) of a range to chunks of conversations."""
    chunks, place = _Chunks(chunk_tokens, schema), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bpe, place, keys = loaded(vocab), batch.column(1)[0].as_py(), batch.column(0).to_pylist()
        made = [encode_turn(bpe, role, text, role == learn)
                for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        lengths = np.array([len(ids) for ids, _, _ in made], np.int64)
        flat = np.concatenate([ids for ids, _, _ in made])
        mask = loss_mask(lengths, np.array([m[1] for m in made]), np.array([m[2] for m in made]))
        ends = np.cumsum(lengths)
        first = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(first, first[1:], strict=False):
            if not chunks.begun or keys[a] != chunks.conv:
                chunks.begin(keys[a])
            chunks.add(flat[ends[a] - lengths[a]:ends[b - 1]], mask[ends[a] - lengths[a]:ends[b - 1]])
        chunks.cut()
        if sum(len(o[2]) for o in chunks.out) > 1 << 20:
            yield chunks.flush(place)
    if chunks.begun:
        chunks.stop()
        yield chunks.flush(place)


def format_conversations(turns: DataFrame, learn: str = "assistant", chunk_tokens: int = 1 << 16,
                         vocab: str | None = None, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` (a row per turn) as (conv_id, chunk, ids, loss): ids of the conversation cut
    into chunks of at most ``chunk_tokens`` (2 or more), numbered from 0, and a flag per id that is
    true for the text of turns whose role is ``learn``.

    Turns come in order of ``turn`` (null last; equal ones in order of role, then of the first 64
    characters of the text, then of its SHA-256, so whatever the order of the rows; repeated rows
    each). Null roles and texts count as empty; rows with a null conversation id form one
    conversation. Ids may have any type that has an order. A conversation ends with
    ``<|endoftext|>``. Other columns are ignored; an empty table gives no rows. A conversation of
    any length, or of equal rows only, is spread over as many tasks as its share of the rows.
    """
    if chunk_tokens < 2:
        raise ValueError("chunk_tokens must be 2 or more")
    ship(turns.sparkSession)
    key, vocab = turns.schema[id_col].dataType, vocab or public("byte_bpe_50k.tiktoken")
    # range partitioning looks at its input twice; a plan that is not a plain scan is written first
    rows = settled(turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                text_of(role_col).alias("role"), text_of(text_col).alias("text")), "turns")
    order = ["conv_id", F.col("turn").asc_nulls_last(), "role", F.substring("text", 1, HEAD), F.sha2("text", 256)]
    ranges = (rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "copy")
              .sortWithinPartitions(*order).select("conv_id", F.spark_partition_id().alias("place"), "role", "text"))
    made = StructType([StructField("conv_id", key), StructField("place", IntegerType()), StructField("nth", IntegerType()),
                       StructField("ids", ArrayType(IntegerType())), StructField("loss", ArrayType(BooleanType())),
                       StructField("edge", BooleanType()), StructField("closed", BooleanType())])
    arrow = pa.schema([("conv_id", to_arrow_type(key)), ("place", pa.int32()), ("nth", pa.int32()), ("ids", pa.list_(pa.int32())),
                       ("loss", pa.list_(pa.bool_())), ("edge", pa.bool_()), ("closed", pa.bool_())])
    chunks = written(ranges.mapInArrow(partial(_assemble, learn=learn, vocab=vocab, chunk_tokens=chunk_tokens, schema=arrow), made),
                     "chat_chunks")
    # two rows a range at most, so a bounded broadcast
    of_one = Window.partitionBy("conv").orderBy("at")
    edges = written(chunks.where("edge").select(F.col("conv_id").alias("conv"), F.col("place").alias("at"), F.col("nth"))
                    .select("conv", "at", F.sum(F.col("nth") + 1).over(of_one.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                            F.lead("at").over(of_one).isNull().alias("last")), "chat_edges")
    placed = chunks.join(F.broadcast(edges), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("place") == F.col("at")), "left")
    ending = F.col("edge") & ~F.col("closed") & F.col("last")
    return placed.select(
        "conv_id", (F.col("nth") + F.coalesce("before", F.lit(0))).cast("int").alias("chunk"),
        F.when(ending, F.concat("ids", F.array(F.lit(END)))).otherwise(F.col("ids")).alias("ids"),
        F.when(ending, F.concat("loss", F.array(F.lit(False)))).otherwise(F.col("loss")).alias("loss"))


def _spoken(bpe: Bpe, ids: np.ndarray) -> bytes:
    """What ``ids`` say, still escaped: a newline behind a role and behind a text, nothing for other reserved ids."""
    said = ids[(ids < END) | (ids == BODY) | (ids == CLOSE)]
    said[said >= END] = bpe.encode("\n")[0]
    return bpe.decode(said)


def _plain(said: bytes) -> bytes:
    return _UNESCAPE_BYTES.sub(rb"\1", said) if b"\\" in said else said


def _chars(utf8: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(utf8, np.uint8) & 0xC0 != 0x80))


def _say(bpe: Bpe, ids: np.ndarray, loss: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """(turns that end here, characters of the decoded form, what all ids say, what the learned ones say)."""
    kinds = {k: int(np.count_nonzero(ids == k)) for k in RESERVED}
    said = _spoken(bpe, ids)
    shown = _chars(said) - kinds[BODY] - kinds[CLOSE] + sum(len(RESERVED[k]) * n for k, n in kinds.items())
    return kinds[CLOSE], shown, said, _spoken(bpe, ids[loss & (ids < END)])


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(conv_id, chunk, ids, loss) of each row."""
    for key, chunk, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
        yield key, chunk, ids.values.to_numpy(zero_copy_only=False), loss.values.to_numpy(zero_copy_only=False).astype(bool)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _read_whole(batches: Iterable[pa.RecordBatch], vocab: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations of one chunk."""
    for batch in batches:
        bpe, rows = loaded(vocab), []
        for key, _, ids, loss in _arrays(batch):
            turns, shown, said, learned = _say(bpe, ids, loss)
            learned = _plain(learned)
            rows.append((key, turns, hashlib.sha256(_plain(said)).hexdigest(), _chars(learned), hashlib.sha256(learned).hexdigest(), shown))
        yield _rows(rows, schema)


def _cut_runs(said: bytes) -> tuple[int, bytes, int]:
    """(backslashes at the begin, what lies between, unescaped, backslashes at the end): a run of
    backslashes may go on in the next chunk, and half of the whole run stand for themselves."""
    rest = said.lstrip(b"\\")
    body = rest.rstrip(b"\\")
    return len(said) - len(rest), _plain(body), len(rest) - len(body)


def _read_chunks(batches: Iterable[pa.RecordBatch], vocab: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bpe, rows = loaded(vocab), []
        for key, chunk, ids, loss in _arrays(batch):
            turns, shown, said, learned = _say(bpe, ids, loss)
            rows.append((key, chunk, turns, shown, *_cut_runs(said), *_cut_runs(learned)))
        yield _rows(rows, schema)


class _Digest:
    """SHA-256 and characters of parts as ``_cut_runs`` gives them."""

    def __init__(self):
        self.sha, self.chars, self.run = hashlib.sha256(), 0, 0

    def _put(self, data: bytes) -> None:
        self.sha.update(data)
        self.chars += _chars(data)

    def add(self, lead: int, body: bytes, tail: int) -> None:
        self.run += lead
        if body:
            self._put(b"\\" * (self.run // 2))
            self._put(body)
            self.run = tail

    def end(self) -> str:
        self._put(b"\\" * (self.run // 2))
        self.run = 0
        return self.sha.hexdigest()


def _meet(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted parts of conversations to a row each; a part is held at a time."""
    def row() -> tuple:
        digests = said.end(), learned.end()
        return conv, turns, digests[0], learned.chars, digests[1], shown

    begun, conv, turns, shown, said, learned = False, None, 0, 0, _Digest(), _Digest()
    for batch in batches:
        rows = []
        for part in zip(*(c.to_pylist() if k < 4 else c for k, c in enumerate(batch.columns)), strict=True):
            if not begun or part[0] != conv:
                if begun:
                    rows.append(row())
                begun, conv, turns, shown, said, learned = True, part[0], 0, 0, _Digest(), _Digest()
            turns, shown = turns + part[2], shown + part[3]
            values = [v.as_py() for v in part[4:]]
            said.add(*values[:3])
            learned.add(*values[3:])
        yield _rows(rows, schema)
    if begun:
        yield _rows([row()], schema)


def read_back(formatted: DataFrame, vocab: str | None = None) -> DataFrame:
    """Per conversation of ``format_conversations``: conv_id, n_turns, turns_sha256 (role,
    newline, text, newline of each turn), loss_chars and loss_sha256 (the text under the loss
    mask), formatted_chars (of the decoded form with its control strings). Texts are decoded
    from the ids and unescaped. Chunks are decoded where they lie; what the chunks of a longer
    conversation say is hashed in order, a chunk at a time."""
    ship(formatted.sparkSession)
    key, vocab = formatted.schema["conv_id"].dataType, vocab or public("byte_bpe_50k.tiktoken")

    def run(rows: DataFrame, work: Callable, columns: list[tuple[str, DataType]], **given) -> DataFrame:
        arrow = pa.schema([(name, to_arrow_type(kind)) for name, kind in columns])
        return rows.mapInArrow(partial(work, schema=arrow, **given), StructType([StructField(*c) for c in columns]))

    result = [("conv_id", key), ("n_turns", LongType()), ("turns_sha256", StringType()), ("loss_chars", LongType()),
              ("loss_sha256", StringType()), ("formatted_chars", LongType())]
    part = [("conv_id", key), ("chunk", IntegerType()), ("turns", LongType()), ("shown", LongType()),
            *[(f"{of}_{what}", kind) for of in ("said", "learned")
              for what, kind in (("lead", LongType()), ("body", BinaryType()), ("tail", LongType()))]]
    formatted = formatted.select("conv_id", "chunk", "ids", "loss")
    whole = (F.col("chunk") == 0) & F.coalesce(F.get("ids", F.size("ids") - 1) == END, F.lit(False))
    parts = run(formatted.where(~whole), _read_chunks, part, vocab=vocab).repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return run(formatted.where(whole), _read_whole, result, vocab=vocab).unionByName(run(parts, _meet, result))
