"""Chat formatting with a prefix tree (operator 5).

Conversations that share initial turns share the nodes of a prefix tree.  A
pack is a depth-first walk of (part of) the tree: every node's tokens occur
once, with the position ids they have in each conversation through them and
the intervals of the pack that its ancestors occupy, which together with the
node itself are all a token may attend to.

Template (fixed): ``<|turn|>role<|text|>text<|end|>`` per turn.  Inside roles
and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so that control
strings never occur there and unescaping is exact.  Loss falls on assistant
texts only, not on the template around them.

Scale: one shuffle sorts the turns of each conversation, which are then read
as a stream: a node's name is the hash chain of its turns, and the names of
the first ``ORDER_DEPTH`` turns become the conversation's sort key.  A range
partition on (key, conversation) brings sharing conversations next to each
other; each partition is one walk, again a stream that holds one path.  A hot
first turn is thus spread over many partitions, each of which repeats the
shared turns once per pack.  Packs are closed at a conversation's end once
they hold ``PACK_TOKENS`` tokens.  No group is ever collected.

Defined results: null texts and roles count as empty; a null id is a
conversation of its own; turns go by number, nulls first, repeated numbers by
role, then text; repeated rows are turns of their own; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import stash

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"
ORDER_DEPTH = 12
PACK_TOKENS = 65_536
BATCH = 2_000

_CONTROL = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def parse_turn(segment: str) -> tuple[str, str]:
    m = _CONTROL.fullmatch(segment)
    if m is None:
        raise ValueError("not a formatted turn")
    return unescape(m.group(1)), unescape(m.group(2))


class Coder:
    """Tokens of a formatted turn: ids of a byte-level vocabulary in tiktoken's
    rank format, or UTF-8 bytes without one.  Both decode exactly."""

    def __init__(self, vocabulary: str | None):
        self.encoding = None
        if vocabulary:
            import tiktoken
            with open(vocabulary, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text) if self.encoding else list(text.encode())

    def decode(self, ids: list[int]) -> str:
        return (self.encoding.decode_bytes(ids) if self.encoding else bytes(ids)).decode()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def chained_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, node, order_key, role, text, last): the turns of each
    conversation, numbered, with the name of their node and the
    conversation's sort key.  ``conversations`` has conv_id, turn, role, text."""
    kind = conversations.schema["conv_id"].dataType
    src = (conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
           .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("idx", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("order_key", T.BinaryType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("last", T.BooleanType())])
    names = schema.names

    def walk(rows):
        conv, idx, node, held, key = object(), 0, b"", [], None
        waiting = None  # the last row, whose ``last`` isn't known yet

        for conv_id, _, role, text in rows:
            if conv_id != conv:
                if waiting:
                    held.append(waiting[:6] + (True,))
                if held:
                    key = b"".join(h[2] for h in held[:ORDER_DEPTH]) if key is None else key
                    yield from ((*h[:3], key, *h[4:]) for h in held)
                conv, idx, node, held, key, waiting = conv_id, 0, b"", [], None, None
            if waiting:
                held.append(waiting[:6] + (False,))
                if key is None and len(held) == ORDER_DEPTH:
                    key = b"".join(h[2] for h in held)
                if key is not None:
                    yield from ((*h[:3], key, *h[4:]) for h in held)
                    held = []
            name = hashlib.blake2b(digest_size=16, key=node)
            for part in (role, text):
                raw = part.encode()
                name.update(len(raw).to_bytes(8, "little") + raw)
            node = name.digest()
            waiting = (conv_id, idx, node, None, role, text)
            idx += 1
        if waiting:
            held.append(waiting + (True,))
            key = b"".join(h[2] for h in held[:ORDER_DEPTH]) if key is None else key
            yield from ((*h[:3], key, *h[4:]) for h in held)

    def run(batches):
        arrow = None
        rows = _peek_schema(batches)
        first = next(rows, None)
        if first is None:
            return
        conv_type = first
        arrow = pa.schema([("conv_id", conv_type), ("idx", pa.int64()), ("node", pa.binary()),
                           ("order_key", pa.binary()), ("role", pa.string()), ("text", pa.string()),
                           ("last", pa.bool_())])
        assert arrow.names == names
        yield from _batches(walk(rows), arrow)

    return src.mapInArrow(run, schema)


def _peek_schema(batches: Iterator[pa.RecordBatch]):
    """First the Arrow type of column 0, then the rows."""
    told = False
    for batch in batches:
        if not told:
            told = True
            yield batch.schema.field(0).type
        yield from zip(*(c.to_pylist() for c in batch.columns))


def pack(conversations: DataFrame, vocabulary: str | None = None, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """The packed prefix tree: a row per node and pack, in pack order:

    part, seq        place of the row: partition of the walk, number in it
    pack             number of the pack in its partition
    depth            0 for a first turn
    start            offset of the node's tokens in its pack
    position         position id of its first token
    tokens           token ids of the formatted turn
    ancestors        array of [start, end) intervals it may attend to besides itself
    loss             whether the turn's text bears loss
    ends             ids of the conversations that end at this node
    """
    turns = chained_turns(conversations)
    order = ["order_key", "conv_id", "idx"]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stash(turns, "turns").repartitionByRange(parts, "order_key", "conv_id").sortWithinPartitions(*order)
    kind = conversations.schema["conv_id"].dataType
    interval = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("pack", T.LongType()), T.StructField("depth", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("position", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("ancestors", T.ArrayType(interval)),
        T.StructField("loss", T.BooleanType()), T.StructField("ends", T.ArrayType(kind))])

    def run(batches):
        from pyspark import TaskContext

        rows = _peek_schema(batches)
        conv_type = next(rows, None)
        if conv_type is None:
            return
        coder, part = Coder(vocabulary), TaskContext.get().partitionId()
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        arrow = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("pack", pa.int64()), ("depth", pa.int32()),
                           ("start", pa.int64()), ("position", pa.int64()), ("tokens", pa.list_(pa.int32())),
                           ("ancestors", pa.list_(span)), ("loss", pa.bool_()), ("ends", pa.list_(conv_type))])

        def walk():
            path: list[list] = []  # of the nodes that are open: [node, tokens, start, end, position end, pack]
            seq = number = used = 0
            fresh = True  # the next conversation opens a pack
            matched = True
            # a conversation's end is told by a row of its own: depth of the
            # node, no tokens
            for conv_id, idx, node, _, role, text, last in rows:
                if idx == 0 and fresh:
                    for x in path:
                        x[5] = -1  # to be repeated in the new pack when reached
                    fresh, used = False, 0
                    if seq:
                        number += 1
                same = idx < len(path) and path[idx][0] == node
                if same and path[idx][5] == number:
                    pass
                else:
                    if not same:
                        del path[idx:]
                        path.append([node, coder.encode(format_turn(role, text)), 0, 0, 0, -1])
                    x = path[idx]
                    position = path[idx - 1][4] if idx else 0
                    x[2], x[3], x[4], x[5] = used, used + len(x[1]), position + len(x[1]), number
                    used = x[3]
                    yield (part, seq, number, idx, x[2], position, x[1],
                           [{"start": a[2], "end": a[3]} for a in path[:idx]], role == ASSISTANT, [])
                    seq += 1
                if last:
                    yield (part, seq, number, idx, path[idx][2], path[idx][4], [], [], False, [conv_id])
                    seq += 1
                    fresh = used >= pack_tokens

        yield from _batches(walk(), arrow)

    return laid.mapInArrow(run, schema)


def read_back(packed: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per conversation, from the packed tree alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.  Each partition of
    the walk is read in order; digests are carried down the open path, so that
    shared turns are decoded and hashed once."""
    kind = packed.schema["ends"].dataType.elementType
    schema = T.StructType([
        T.StructField("conv_id", kind), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        coder = Coder(vocabulary)
        arrow = None
        held: list[dict] = []
        states: list[tuple] = []  # per open node: turns digest, loss chars, loss digest, chars
        part = None
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([("conv_id", batch.schema.field("ends").type.value_type), ("n_turns", pa.int64()),
                                   ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for row in batch.select(["part", "depth", "tokens", "loss", "ends"]).to_pylist():
                if row["part"] != part:
                    part, states = row["part"], []
                depth = row["depth"]
                if row["ends"]:
                    turns, loss_chars, loss, chars = states[depth]
                    held += [{"conv_id": c, "n_turns": depth + 1, "turns_sha256": turns.hexdigest(),
                              "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(),
                              "formatted_chars": chars} for c in row["ends"]]
                    continue
                segment = coder.decode(row["tokens"])
                role, text = parse_turn(segment)
                del states[depth:]
                turns, loss_chars, loss, chars = states[-1] if states else (hashlib.sha256(), 0, hashlib.sha256(), 0)
                turns = turns.copy()
                turns.update(f"{role}\n{text}\n".encode())
                if row["loss"]:
                    loss = loss.copy()
                    loss.update(text.encode())
                    loss_chars += len(text)
                states.append((turns, loss_chars, loss, chars + len(segment)))
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []

    ordered = packed.repartition("part").sortWithinPartitions("part", "seq")
    return ordered.select("part", "depth", "tokens", "loss", "ends").mapInArrow(run, schema)
