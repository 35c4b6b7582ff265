"""Chat formatting by columnar byte assembly.

Conversations are sorted by (conv_id, turn) inside hash partitions and flow
through as Arrow batches. For a run of turns the lengths of all segments
(header, content, footer) are added up to offsets, and headers, contents and
footers are scattered into one preallocated byte buffer, which becomes the
Arrow string column as it is. Conversations are the slices of that buffer.

Template: ``<|im_start|>role LF content<|im_end|> LF``. Inside contents a
backslash is put behind ``<`` wherever ``<``, any backslashes and ``|`` follow
each other; reading takes one away again, so no content can hold a control
string and every content comes back unchanged. Roles are escaped likewise, and
their line feeds and backslashes are written as ``\\n`` and ``\\\\``.

The loss mask covers the contents (not headers, not footers) of assistant
turns, as spans of code points in the formatted text.

Defined results: null role or text: empty; turns sort nulls first, ties by
role, then text; rows without conv_id form one conversation; repeated rows are
separate turns; an empty table gives no rows. One conversation is one value,
so it is held whole by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._words import chunks, column_bytes

START, END, LF = b"<|im_start|>", b"<|im_end|>", b"\n"
LOSS_ROLE = "assistant"
BLOCK = 4 << 20      # bytes of contents that are assembled at once

SCHEMA = "conv_id {id}, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"


def _escaped(column: pa.Array) -> pa.Array:
    """Contents with their control strings broken up."""
    if not pc.any(pc.match_substring(column, "<")).as_py():
        return column
    return pc.replace_substring_regex(column, pattern=r"<(\\*)\|", replacement=r"<\\\1|")


def unescape(content: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", content) if "<\\" in content else content


def _header(role: str) -> bytes:
    role = role.replace("\\", "\\\\").replace("\n", "\\n")
    return START + re.sub(r"<(\\*)\|", r"<\\\1|", role).encode() + LF


def _read_role(line: str) -> str:
    line = unescape(line)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns one behind the other, the n+1 offsets
    of turns, and the first and last+1 byte of each content."""
    coded = pc.dictionary_encode(roles.fill_null(""))
    heads = [_header(r) for r in coded.dictionary.to_pylist()] or [b""]
    code = np.asarray(coded.indices, dtype=np.int64)
    head_len = np.array([len(h) for h in heads], np.int64)
    foot = np.frombuffer(END + LF, np.uint8)
    raw, bounds = column_bytes(_escaped(texts.fill_null("")))
    content_len = np.diff(bounds)
    turn_at = np.zeros(len(code) + 1, np.int64)
    np.cumsum(head_len[code] + content_len + len(foot), out=turn_at[1:])
    out = np.empty(int(turn_at[-1]), np.uint8)
    content_at = turn_at[:-1] + head_len[code]
    for k, h in enumerate(heads):
        own = turn_at[:-1][code == k]
        out[own[:, None] + np.arange(len(h))] = np.frombuffer(h, np.uint8)
    for i, j in chunks(bounds, BLOCK):
        lo, hi = int(bounds[i]), int(bounds[j])
        if j - i == 1:
            out[content_at[i]:content_at[i] + hi - lo] = raw[lo:hi]
        else:
            out[np.arange(lo, hi) + np.repeat(content_at[i:j] - bounds[i:j], content_len[i:j])] = raw[lo:hi]
    content_end = content_at + content_len
    out[content_end[:, None] + np.arange(len(foot))] = foot
    return out, turn_at, content_at, content_end


def _chars(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of ``data`` before each of the (ascending) byte positions."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return lead[at]


def _conversations(batch: pa.Table, types: pa.Schema) -> pa.RecordBatch:
    """Formats whole conversations: rows are sorted, none is cut off."""
    ids = batch.column("conv_id").combine_chunks()
    same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    edge = np.append(first, len(ids))
    roles = batch.column("role").combine_chunks()
    out, turn_at, content_at, content_end = assemble(roles, batch.column("text").combine_chunks())
    loss = np.asarray(pc.fill_null(pc.equal(roles, LOSS_ROLE), False))
    base = np.repeat(turn_at[edge[:-1]], np.diff(edge))
    lead_base = _chars(out, base)
    spans = pa.StructArray.from_arrays([pa.array((_chars(out, content_at) - lead_base)[loss]),
                                        pa.array((_chars(out, content_end) - lead_base)[loss])], ["start", "end"])
    loss_before = np.zeros(len(loss) + 1, np.int64)
    np.cumsum(loss, out=loss_before[1:])
    offsets = turn_at[edge]
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    columns = [ids.take(pa.array(first)), pa.array(np.diff(edge)), text,
               pa.ListArray.from_arrays(pa.array(loss_before[edge].astype(np.int32)), spans)]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types.types)], schema=types)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last conversation of a batch waits for the rest of its turns."""
    waiting: list[pa.Table] = []
    types = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).select(["conv_id", "role", "text"])
        types = types or pa.schema([("conv_id", table.schema.field("conv_id").type), ("n_turns", pa.int64()), ("formatted", pa.large_string()),
                                    ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        ids = table.column("conv_id").combine_chunks()
        last, held = ids[-1].as_py(), waiting[0].column("conv_id")[0].as_py() if waiting else None
        if waiting and held == last == ids[0].as_py():
            waiting.append(table)
            continue
        code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(code != code[-1])[-1]) + 1 if (code != code[-1]).any() else 0
        whole = [*waiting, table.slice(0, cut)] if cut else waiting
        waiting = [table.slice(cut)]
        if whole:
            yield _conversations(pa.concat_tables(whole).combine_chunks(), types)
    if waiting:
        yield _conversations(pa.concat_tables(waiting).combine_chunks(), types)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans."""
    kind = rows.schema[conv].dataType.simpleString()
    slim = rows.select(rows[conv].alias("conv_id"), rows[turn].alias("turn"), rows[role].cast("string").alias("role"), rows[text].alias("text"))
    return (slim.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
            .select("conv_id", "role", "text")
            .mapInArrow(_format, SCHEMA.format(id=kind)))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation: role and content, unescaped."""
    turns = []
    for part in formatted.split(START.decode())[1:]:
        line, _, rest = part.partition("\n")
        turns.append((_read_role(line), unescape(rest[:-len(END) - 1])))
    return turns


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {"conv_id": [], "n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
        for conv, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
            turns = parse(formatted)
            all_turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, text in turns:
                all_turns.update(f"{role}\n{text}\n".encode())
            for s in spans:
                part = unescape(formatted[s["start"]:s["end"]])
                chars += len(part)
                loss.update(part.encode())
            for c, v in zip(found.values(), (conv, len(turns), all_turns.hexdigest(), chars, loss.hexdigest(), len(formatted))):
                c.append(v)
        types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), types)], names=list(found))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say when they are parsed."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(_read_back, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
