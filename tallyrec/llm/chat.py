"""Chat formatting as a prefix forest.

Every turn is formatted with role markers; control strings inside texts are escaped
reversibly. Conversations that begin with the same turns share them: a turn's place in
the forest is a hash chain over all turns up to it. Conversations are range-sorted by
their chains, which is depth-first order; each emits only the turns that its predecessor
in that order does not share, so shared tokens stand in the output once. A turn carries
its place in the output, the position id of its first token in its conversation, and the
intervals of the output that hold its ancestors, which is all it may attend to besides
itself. Only the tokens of an assistant's text are under the loss mask.

Rows of a conversation are streamed in order through one task and hashed as they pass;
its text is never gathered. (Its chain, 16 bytes a turn, is.) The order is total, so
copies of one conversation stand side by side and spread over partitions by their ids.
One row per partition goes to the driver: its first and last chain and token counts.

Defined results: turns are ordered by turn, then role and text; a null text or role is
empty; rows without a conversation id form one conversation without id; repeated rows
are turns of their own; an empty table gives empty tables; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import map_arrow
from tallyrec.sources.stage import materialise, stage_root

#: Strings that mark turns; inside texts a backslash is put before them.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
_CONTROL = "|".join(re.escape(c) for c in ("\\", *CONTROLS))
_ESCAPE = re.compile(f"({_CONTROL})")
_UNESCAPE = re.compile(rf"\\({_CONTROL})")
_BRACKETS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
_NODE = 16


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands behind it."""
    if role in _BRACKETS:
        before, behind = _BRACKETS[role]
        return before, escape(text), behind
    return f"[ROLE]{escape(role)}[/ROLE]", escape(text), "</s>"


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    for role, (before, behind) in _BRACKETS.items():
        if formatted.startswith(before) and formatted.endswith(behind):
            return role, unescape(formatted[len(before) : len(formatted) - len(behind)])
    found = re.fullmatch(r"\[ROLE\](.*?)(?<!\\)((?:\\\\)*)\[/ROLE\](.*)</s>", formatted, re.DOTALL)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1] + found[2]), unescape(found[3])


@functools.cache
def _encoding(path: str, pattern: str):  # noqa: ANN202
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class Forest:
    """Result of `chat_forest`."""

    #: One row per distinct turn in its context: start (place of its first token in the
    #: output, unique), n_tokens, position (id of its first token), depth, ancestors (array
    #: of [from, to) intervals of the output), text (formatted), tokens (little-endian
    #: unsigned 32-bit), mask_from and mask_to (tokens under the loss mask, counted from
    #: the turn's first), text_from and text_to (the same in characters).
    turns: DataFrame
    #: One row per conversation: key, conv_id, starts (its turns in order).
    conversations: DataFrame


_TURNS = (
    "key string, conv_id bigint, i bigint, text string, tokens binary, n_tokens bigint, mask_from bigint, "
    "mask_to bigint, text_from bigint, text_to bigint, chain binary, lengths binary"
)


def _format_rows(ordered: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Formatted turns, and behind those of a conversation a row (i = -1) with its chain."""
    names = [x.split()[0] for x in _TURNS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), *[pa.int64()] * 5]
    kinds += [pa.binary(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks, pattern).encode_ordinary
        key, conv, node = None, None, b""
        chain: list[bytes] = []
        lengths: list[int] = []

        def closing() -> tuple:
            return (
                (key, conv, -1, *[None] * 7, b"".join(chain), np.array(lengths, dtype="<i8").tobytes())
            )

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )

        for batch in batches:
            rows = []
            for k, c, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if k != key:
                    if chain:
                        rows.append(closing())
                    key, conv, node, chain, lengths = k, c, b"", [], []
                role, text = role or "", text or ""
                node = hashlib.blake2b(
                    node + hashlib.blake2b(role.encode()).digest() + text.encode(), digest_size=_NODE
                ).digest()
                before, body, behind = format_turn(role, text)
                head, middle, tail = encode(before), encode(body), encode(behind)
                tokens = np.array(head + middle + tail, dtype="<u4")
                masked = role == "assistant"
                rows.append(
                    (
                        key,
                        conv,
                        len(chain),
                        before + body + behind,
                        tokens.tobytes(),
                        len(tokens),
                        len(head) if masked else 0,
                        len(head) + len(middle) if masked else 0,
                        len(before) if masked else 0,
                        len(before) + len(body) if masked else 0,
                        None,
                        None,
                    )
                )
                chain.append(node)
                lengths.append(len(tokens))
            if rows:
                yield packed(rows)
        if chain:
            yield packed([closing()])

    return map_arrow(ordered, ["key", "conv_id", "role", "text"], run, _TURNS)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two chains have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // _NODE
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    return int((x != y).argmax()) // _NODE


def _starts(starts: np.ndarray, shared: int, lengths: np.ndarray, at: int) -> np.ndarray:
    """Places of a conversation's turns: shared ones as before, the rest from ``at`` on."""
    new = lengths[shared:]
    return np.concatenate([starts[:shared], at + np.cumsum(new) - new])


def _partition_ends(chains: DataFrame) -> list:
    """By partition: first chain and lengths, last chain with local places, number of tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, starts, at = None, b"", np.empty(0, dtype=np.int64), 0
        for batch in batches:
            for chain, lengths in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                size = np.frombuffer(lengths, "<i8")
                first = first or (chain, lengths)
                shared = _shared(last, chain)
                starts = _starts(starts, shared, size, at)
                at += int(size[shared:].sum())
                last = chain
        if first:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int64()),
                    *(pa.array([x], pa.binary()) for x in (*first, last, starts.astype("<i8").tobytes())),
                    pa.array([at], pa.int64()),
                ],
                ["part", "first", "first_lengths", "last", "starts", "total"],
            )

    schema = "part bigint, first binary, first_lengths binary, last binary, starts binary, total bigint"
    return sorted(chains.mapInArrow(run, schema).collect())


def _partition_states(ends: list) -> dict[int, tuple[bytes, np.ndarray, int]]:
    """By partition: the chain before its first row, places of its turns, next free place."""
    states, chain, starts, base = {}, b"", np.empty(0, dtype=np.int64), 0
    for part, first, first_lengths, last, local, total in ends:
        states[part] = (chain, starts, base)
        shared = _shared(chain, bytes(first))
        skip = int(np.frombuffer(bytes(first_lengths), "<i8")[:shared].sum())
        local = np.frombuffer(bytes(local), "<i8")
        # what the first row shares with the partition before keeps its place there
        before = local < skip
        fixed = local + base - skip
        fixed[before] = starts[: before.sum()]
        chain, starts, base = bytes(last), fixed, base + total - skip
    return states


def _emit(chains: DataFrame, states: dict) -> DataFrame:
    """Per conversation its places; per newly emitted turn its place, position and ancestors."""
    shared_states = chains.sparkSession.sparkContext.broadcast(states)
    interval = pa.struct([("from", pa.int64()), ("to", pa.int64())])
    fields = [
        ("key", pa.string()),
        ("i", pa.int64()),
        ("start", pa.int64()),
        ("position", pa.int64()),
        ("ancestors", pa.list_(interval)),
        ("starts", pa.list_(pa.int64())),
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, starts, at = shared_states.value.get(part, (b"", np.empty(0, dtype=np.int64), 0))
        for batch in batches:
            rows: list[tuple] = []
            for key, chain, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = np.frombuffer(lengths, "<i8")
                shared = _shared(last, chain)
                starts = _starts(starts, shared, size, at)
                position = np.cumsum(size) - size
                # neighbouring ancestors make one interval
                a, b = starts[:shared], starts[:shared] + size[:shared]
                cut = np.flatnonzero(a[1:] != b[:-1]) + 1
                held = [
                    {"from": int(x), "to": int(y)}
                    for x, y in zip(a[[0, *cut]], b[[*(cut - 1), -1]], strict=True)
                ] if shared else []
                for d in range(shared, len(size)):
                    own = held
                    if d > shared:
                        if held and held[-1]["to"] == at:
                            own = [*held[:-1], {"from": held[-1]["from"], "to": int(starts[d])}]
                        else:
                            own = [*held, {"from": at, "to": int(starts[d])}]
                    rows.append((key, d, int(starts[d]), int(position[d]), own, None))
                rows.append((key, -1, None, None, None, starts.tolist()))
                at += int(size[shared:].sum())
                last = chain
                if len(rows) >= 5000:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields]
        )

    return chains.mapInArrow(
        run,
        "key string, i bigint, start bigint, position bigint, "
        "ancestors array<struct<from: bigint, to: bigint>>, starts array<bigint>",
    )


def chat_forest(df: DataFrame, ranks: str, pattern: str) -> Forest:
    """Formats conversations given as rows (conv_id, turn, role, text)."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    ordered = rows.repartition(partitions, "key").sortWithinPartitions("key", "turn", "role", "text")
    formatted = materialise(_format_rows(ordered, ranks, pattern), "chat-turns")

    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(stage_root(spark))
    # two passes over the same partitions in the same order: their rows are kept as they are
    chains = (
        formatted.where("i < 0")
        .select("key", "chain", "lengths")
        .repartitionByRange(partitions, "chain", "key")
        .sortWithinPartitions("chain", "key")
        .checkpoint()
    )
    emitted = materialise(_emit(chains, _partition_states(_partition_ends(chains))), "chat-places")
    turns = (
        emitted.where("i >= 0")
        .select("key", "i", "start", "position", "ancestors")
        .join(formatted.drop("chain", "lengths", "conv_id"), ["key", "i"])
        .withColumnRenamed("i", "depth")
        .drop("key")
    )
    conversations = (
        emitted.where("i < 0")
        .select("key", "starts")
        .join(formatted.where("i < 0").select("key", "conv_id"), "key")
    )
    return Forest(materialise(turns, "chat-forest"), materialise(conversations, "chat-members"))


def read_back(forest: Forest) -> DataFrame:
    """Digests of every conversation, from the emitted turns alone."""
    spark = forest.turns.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        forest.conversations.select("key", "conv_id", F.posexplode("starts").alias("i", "start"))
        .join(forest.turns.select("start", "text", "text_from", "text_to"), "start")
        .select("key", "conv_id", "i", "text", "text_from", "text_to")
        .repartition(partitions, "key")
        .sortWithinPartitions("key", "i")
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, conv, _, text, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if state:
                        done.append(state)
                    key, state = k, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
                masked = unescape(text[low:high])
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(text)
            if done:
                yield packed(done)
        if state:
            yield packed([state])

    def packed(states: list[list]) -> pa.RecordBatch:
        values = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in s] for s in states]
        columns = zip(*values, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    return rows.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
