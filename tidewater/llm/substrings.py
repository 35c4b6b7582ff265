"""Substring deduplication by level-wise doubling.

A window is ``WINDOW`` (13) consecutive words of one document. Every word is
removed that a window covers whose word sequence also starts in a document with
a smaller id; windows are judged on the input.

Levels. Only windows repeated at one length are extended to the next:

1. length 7: of every 13-word window the least of its seven 7-word hashes is
   looked up. Equal windows have equal least hashes, so a window can only
   repeat if that 7-word window does, and about a quarter of all 7-word windows
   are ever shuffled.
2. length 13 (two overlapping halves): hashes of windows whose 7-word window
   repeats. The least document of each hash decides what is removed.
3. lengths 26, 52, ... (``extend``): a window whose two halves repeat is a
   candidate; a level's repeated windows are the next one's halves, until no
   candidate survives. This gives each document's longest repeat.

Shuffles. Documents are dealt to batches of a few megabytes by a hash of their
id. A batch sends each of its *different* hashes once, packed by hash range, to
that range's reducer, and gets the repeated ones back. A passage in a third of
all documents therefore costs a reducer one entry per batch. Equal texts are
found the same way in step 1, and only the first goes on; the others are
removed whole. The text itself is shuffled once.

Hashes have 63 bits. Two different windows among n collide with probability
n^2 / 2^64; texts are compared by 128 bits.

Defined results: a null text has no words; a text under 13 words loses
nothing; rows with equal ids do not remove each other's words; null ids rank
behind all others; an empty table gives no rows. Only the id and the text are
read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm._store import discard, release, settle
from tidewater.llm._words import SPACED, column_bytes, pair, per_text, windows, word_hashes, words

WINDOW = 13
SEED = 7                      # words; 2 * 7 - 1 = 13
BATCH_BYTES = 4 << 20         # text of a batch
RANGE_BYTES = 32 << 20        # text whose hashes one reducer sees, about
MIN_RANGES = 64
LAST = np.iinfo(np.int64).max

_ONE = np.uint64(1)


def _flagged(hashes: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """Hashes whose lowest bit is the flag."""
    return (hashes & ~_ONE) | flag.astype(np.uint64)


def _distinct(hashes: np.ndarray, docs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes in order, whether two or more documents of the batch
    have them, and the least id that does. Documents are in order of id."""
    hashes = hashes & ~_ONE
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(h)) - 1
    return h[first], d[last] != d[first], ids[d[first]]


class _Batch:
    """The documents of one batch, in order of id, and their words."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        ids = table.column("doc_id").fill_null(LAST).to_numpy()
        raw, bounds = column_bytes(table.column("text"))
        keys = [xxhash.xxh3_128_digest(raw[bounds[i]:bounds[i + 1]].tobytes()) for i in range(len(ids))]
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], keys[i])), np.int64)
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        self.text_keys = np.frombuffer(b"".join(keys[i] for i in order), np.uint64).reshape(-1, 2)
        self.raw, bounds = column_bytes(self.table.column("text"))
        self.starts, self.ends, self.first = words(self.raw, bounds, SPACED)
        self.hashes = word_hashes(self.raw, self.starts, self.ends)
        doc = per_text(self.first)
        at = np.arange(max(0, len(doc) - WINDOW + 1))
        self.at = at[doc[at] == doc[at + WINDOW - 1]]          # windows inside one text
        self.doc = doc[self.at]

    def seeds(self) -> np.ndarray:
        """Of every window the least 7-word hash."""
        s = windows(self.hashes, SEED)
        two = np.minimum(s[:-1], s[1:])
        four = np.minimum(two[:-2], two[2:])
        return np.minimum(four[:-3], four[3:])[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def window_hashes(self, of: np.ndarray) -> np.ndarray:
        return windows(self.hashes, WINDOW)[self.at[of]] if len(self.at) else np.zeros(0, np.uint64)

    def copies(self, moved: np.ndarray) -> np.ndarray:
        """Documents whose text stands in a smaller one: here, or elsewhere as
        the keys in ``moved`` say."""
        _, first, back = np.unique(self.text_keys, axis=0, return_index=True, return_inverse=True)
        back = back.reshape(-1)
        elsewhere = np.isin(self.text_keys[:, 0], moved)
        return (self.ids > self.ids[first][back]) | elsewhere


def _ranges(hashes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of the non-empty hash ranges of sorted hashes."""
    shift = np.uint64(64 - (n.bit_length() - 1))
    own = (hashes >> shift).astype(np.int64) if n > 1 else np.zeros(len(hashes), np.int64)
    cut = np.flatnonzero(np.diff(own)) + 1
    edge = np.concatenate([[0], cut, [len(own)]]) if len(own) else np.zeros(1, int)
    return [(int(own[i]), int(i), int(j)) for i, j in zip(edge[:-1], edge[1:])]


_SENT = "range long, batch long, kind int, hashes binary, ids binary"
_BACK = "batch long, kind int, hashes binary"
_SENT_ARROW = pa.schema([("range", pa.int64()), ("batch", pa.int64()), ("kind", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary())])
_BACK_ARROW = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("hashes", pa.binary())])
TEXTS, WORDS = 0, 1           # kinds of entries: whole texts, windows


def _sent(batch: int, n: int, entries: list[tuple[int, np.ndarray, np.ndarray | None]]) -> pa.Table:
    rows = [(r, batch, kind, h[i:j].tobytes(), ids[i:j].tobytes() if ids is not None else None)
            for kind, h, ids in entries for r, i, j in _ranges(h, n)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 5, _SENT_ARROW)], schema=_SENT_ARROW)


def _number(table: pa.Table) -> int:
    return table.column("batch")[0].as_py()


def _send_seeds(n: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        b = _Batch(table)
        h, several, _ = _distinct(b.seeds(), b.doc, b.ids)
        _, first = np.unique(b.text_keys, axis=0, return_index=True)
        first = first[np.argsort(b.text_keys[first, 0], kind="stable")]
        keys = b.text_keys[first, 0]
        extra = np.stack([b.text_keys[first, 1], b.ids[first].astype(np.uint64)], axis=1)
        return _sent(_number(table), n, [(WORDS, _flagged(h, several), None), (TEXTS, keys, extra)])

    return run


def _reduce(table: pa.Table) -> pa.Table:
    """What of a hash range repeats, back to each batch that has it.

    Texts: keys whose least id is in another batch. Windows without ids: those
    of two batches or documents. With ids: the same, and the lowest bit says
    that a smaller id than the batch's own has it."""
    out = []
    table = table.combine_chunks()
    kinds = table.column("kind").to_numpy()
    batches = table.column("batch").to_numpy()
    for kind in np.unique(kinds):
        own = np.flatnonzero(kinds == kind)
        own = own[np.argsort(batches[own], kind="stable")]
        parts = [np.frombuffer(table.column("hashes")[int(i)].as_buffer(), np.uint64) for i in own]
        source = np.repeat(np.arange(len(own)), [len(p) for p in parts])
        h = np.concatenate(parts)
        ids = [table.column("ids")[int(i)] for i in own]
        with_ids = ids[0].is_valid
        extra = np.concatenate([np.frombuffer(i.as_buffer(), np.uint64).reshape(len(p), -1) for i, p in zip(ids, parts)]) if with_ids else None
        bare = h if kind == TEXTS else h & ~_ONE
        second = extra[:, 0] if kind == TEXTS else np.zeros(len(h), np.uint64)
        order = np.lexsort((second, bare))
        new = np.concatenate([[True], (bare[order][1:] != bare[order][:-1]) | (second[order][1:] != second[order][:-1])])
        group = np.cumsum(new) - 1
        smaller = np.zeros(len(h), bool)
        if with_ids:
            least = extra[order, -1].astype(np.int64)
            smaller = least > np.minimum.reduceat(least, np.flatnonzero(new))[group]
        several = np.bincount(group)[group] > 1
        if kind == TEXTS:
            keep, value = smaller, h[order]
        else:
            several |= np.logical_or.reduceat((h[order] & _ONE) == 1, np.flatnonzero(new))[group]
            keep, value = several, _flagged(bare[order], smaller)
        kept, to = value[keep], source[order][keep]
        by = np.argsort(to, kind="stable")
        kept, to = kept[by], to[by]
        edge = np.searchsorted(to, np.arange(len(own) + 1))
        out += [(int(batches[own[i]]), int(kind), kept[edge[i]:edge[i + 1]].tobytes()) for i in range(len(own)) if edge[i + 1] > edge[i]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 3, _BACK_ARROW)], schema=_BACK_ARROW)


def _answers(table: pa.Table, kind: int) -> np.ndarray:
    """The hashes that came back to a batch, in order."""
    own = [h.as_buffer() for h, k in zip(table.column("hashes"), table.column("kind").to_pylist()) if k == kind]
    return np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in own])) if own else np.zeros(0, np.uint64)


def _member(hashes: np.ndarray, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes came back, and the flag they came with."""
    if not len(answers):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(answers & ~_ONE, hashes & ~_ONE), len(answers) - 1)
    found = (answers[at] & ~_ONE) == (hashes & ~_ONE)
    return found, found & ((answers[at] & _ONE) == 1)


def _candidates(b: _Batch, back: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies of smaller texts, and the windows (of other texts) whose seed
    repeats, with their hashes."""
    copies = b.copies(_answers(back, TEXTS))
    repeated, _ = _member(b.seeds(), _answers(back, WORDS))
    of = np.flatnonzero(repeated & ~copies[b.doc]) if len(b.at) else np.zeros(0, np.int64)
    return copies, of, b.window_hashes(of)


def _send_windows(n: int) -> Callable:
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent(0, n, [])
        b = _Batch(table)
        copies, of, hashes = _candidates(b, back)
        entries = []
        if len(of):
            h, several, least = _distinct(hashes, b.doc[of], b.ids)
            entries.append((WORDS, _flagged(h, several), least.astype(np.uint64)))
        moved = b.text_keys[copies, 0]     # which documents are copies is told once more, to the last step
        sent = _sent(_number(table), n, entries)
        if not len(moved):
            return sent
        own = np.flatnonzero(copies).astype(np.uint64).tobytes()
        note = pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip((_number(table) % n, _number(table), TEXTS, own, None), _SENT_ARROW)], schema=_SENT_ARROW)
        return pa.concat_tables([sent, note])

    return run


def _reduce_windows(table: pa.Table) -> pa.Table:
    """As ``_reduce``; notes about copies pass through."""
    notes = table.filter(pa.compute.equal(table.column("kind"), TEXTS))
    rest = table.filter(pa.compute.equal(table.column("kind"), WORDS))
    out = [notes.select(["batch", "kind", "hashes"]).cast(_BACK_ARROW)]
    return pa.concat_tables([*out, _reduce(rest)] if rest.num_rows else out)


_RESULT = ("batch long, doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string, "
           "longest long, repeats binary")


def _spans(b: _Batch, gone: np.ndarray) -> pa.ListArray:
    """Runs of removed words per document, counted from its first word."""
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    inner = b.first[1:-1]
    both = inner[(inner > 0) & (inner < len(gone))]
    both = both[gone[both] & gone[both - 1]] if len(both) else both
    start = np.sort(np.concatenate([np.flatnonzero(edge == 1), both]))
    end = np.sort(np.concatenate([np.flatnonzero(edge == -1), both]))
    doc = np.searchsorted(b.first, start, side="right") - 1
    offsets = np.searchsorted(doc, np.arange(len(b.ids) + 1))
    spans = pa.StructArray.from_arrays([pa.array(start - b.first[doc]), pa.array(end - b.first[doc])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans)


def _kept_text(b: _Batch, gone: np.ndarray) -> pa.Array:
    """The words that stay, joined by one space."""
    stay = np.flatnonzero(~gone)
    size = b.ends[stay] - b.starts[stay] + 1
    at = np.cumsum(size) - size
    total = int(size.sum())
    out = np.full(total, 0x20, np.uint8)
    step = 1 << 17
    for i in range(0, len(stay), step):
        s, n, a = b.starts[stay[i:i + step]], size[i:i + step] - 1, at[i:i + step]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(a, n) + inside] = b.raw[np.repeat(s, n) + inside]
    edge = np.append(at, total)[np.searchsorted(stay, b.first)]
    data = out.tobytes()
    return pa.array([data[i:j - 1] if j > i else b"" for i, j in zip(edge[:-1], edge[1:])], pa.binary()).cast(pa.string())


def _pack(pos: np.ndarray, hashes: np.ndarray) -> bytes:
    return pos.astype(np.int64).tobytes() + hashes.tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data[:half], np.int64), np.frombuffer(data[half:], np.uint64)


def _finish(schema: pa.Schema) -> Callable:
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        b = _Batch(table)
        copies = np.zeros(len(b.ids), bool)
        copies[_answers(back, TEXTS).astype(np.int64)] = True
        hashes = windows(b.hashes, WINDOW)[b.at] if len(b.at) else np.zeros(0, np.uint64)
        known, smaller = _member(hashes, _answers(back, WORDS))
        known &= ~copies[b.doc]
        of = np.flatnonzero(known)
        later = smaller[of]
        if len(of):
            bare = hashes[of] & ~_ONE
            _, place = np.unique(bare, return_inverse=True)
            least = np.full(int(place.max()) + 1, LAST)
            np.minimum.at(least, place, b.ids[b.doc[of]])
            later = later | (b.ids[b.doc[of]] > least[place])
        n_words = np.diff(b.first)
        cover = np.zeros(len(b.hashes) + 1, np.int64)
        np.add.at(cover, b.at[of[later]], 1)
        np.add.at(cover, b.at[of[later]] + WINDOW, -1)
        gone = np.cumsum(cover[:-1]) > 0
        gone |= np.repeat(copies & (n_words >= WINDOW), n_words)
        sums = np.concatenate([[0], np.cumsum(gone)])
        removed = sums[b.first[1:]] - sums[b.first[:-1]]
        longest = np.where(copies & (n_words >= WINDOW), n_words, 0)
        edge = np.searchsorted(b.doc[of], np.arange(len(b.ids) + 1))
        longest[np.diff(edge) > 0] = WINDOW
        pos = b.at[of] - b.first[b.doc[of]]
        repeats = [_pack(pos[i:j], hashes[of[i:j]]) if j > i else None for i, j in zip(edge[:-1], edge[1:])]
        columns = [pa.array(np.full(len(b.ids), _number(table))), b.table.column("doc_id"), pa.array(n_words), pa.array(removed), _spans(b, gone),
                   _kept_text(b, gone), pa.array(longest), pa.array(repeats, pa.binary())]
        return pa.Table.from_arrays([c.combine_chunks().cast(f.type) if isinstance(c, pa.ChunkedArray) else c.cast(f.type)
                                     for c, f in zip(columns, schema)], schema=schema)

    return run


_RESULT_ARROW = pa.schema([("batch", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                           ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string()),
                           ("longest", pa.int64()), ("repeats", pa.binary())])


def _power(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1, n)))))


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document: batch, doc_id, n_words, n_removed, removed (word spans),
    kept_text (words joined by one space), longest (13 where a window repeats in
    another text, all words for a copy, else 0) and repeats (packed windows for
    ``extend``)."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    n_batches, n = max(1, -(-size // batch_bytes)), max(MIN_RANGES, _power(size / range_bytes))
    key = F.xxhash64(F.coalesce(F.col(doc).cast("long"), F.xxhash64(F.col(text))))
    dealt = docs.select(F.pmod(key, F.lit(n_batches)).alias("batch"), F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seeds = dealt.groupBy("batch").applyInArrow(_send_seeds(n), _SENT).groupBy("range").applyInArrow(_reduce, _BACK)
    found = (dealt.groupBy("batch").cogroup(seeds.groupBy("batch")).applyInArrow(_send_windows(n), _SENT)
             .groupBy("range").applyInArrow(_reduce_windows, _BACK))
    return dealt.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_finish(_RESULT_ARROW), _RESULT)


def _halves(repeats: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of twice the length whose halves repeat: places and hashes."""
    pos, h = _unpack(repeats)
    at = np.minimum(np.searchsorted(pos, pos + length), len(pos) - 1)
    both = pos[at] == pos + length
    return pos[both], pair(h[both], h[at[both]])


def _send_longer(n: int, length: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        hashes, docs = [], []
        for k, data in enumerate(table.column("repeats")):
            if data.is_valid:
                _, h = _halves(data.as_py(), length)
                hashes.append(h)
                docs.append(np.full(len(h), k))
        if not sum(map(len, hashes)):
            return _sent(0, n, [])
        h, several, _ = _distinct(np.concatenate(hashes), np.concatenate(docs), np.arange(table.num_rows))
        return _sent(_number(table), n, [(WORDS, _flagged(h, several), None)])

    return run


def _keep_longer(length: int, names: list[str], schema: pa.Schema) -> Callable:
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        answers = _answers(back, WORDS)
        longest, kept = table.column("longest").to_pylist(), []
        for k, data in enumerate(table.column("repeats")):
            pos, h = _halves(data.as_py(), length) if data.is_valid else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            known, _ = _member(h, answers)
            if known.any():
                longest[k] = 2 * length
            kept.append(_pack(pos[known], h[known]) if known.any() else None)
        new = {"longest": pa.array(longest, pa.int64()), "repeats": pa.array(kept, pa.binary())}
        return pa.Table.from_arrays([new[c] if c in new else table.column(c).cast(schema.field(c).type) for c in names], schema=schema)

    return run


def extend(found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Levels of twice the length until no window survives, for rows with
    batch, longest and repeats (other columns stay). Each level is settled in
    the shared folder, and its predecessor given up."""
    spark, length = found.sparkSession, WINDOW
    now, path = settle(found, "repeats")
    while True:
        left = now.agg(F.sum(F.octet_length("repeats").cast("long"))).first()[0] or 0
        if not left:
            return now.drop("batch", "repeats")
        # only batches with repeats go on; the others' rows wait beside
        n = max(MIN_RANGES, _power(left / range_bytes))
        schema = now.schema
        sent = now.where("repeats IS NOT NULL").groupBy("batch").applyInArrow(_send_longer(n, length), _SENT)
        back = sent.groupBy("range").applyInArrow(_reduce, _BACK)
        longer = (now.where("repeats IS NOT NULL").groupBy("batch").cogroup(back.groupBy("batch"))
                  .applyInArrow(_keep_longer(length, schema.names, to_arrow_schema(schema)), schema))
        after, new_path = settle(longer.union(now.where("repeats IS NULL")), "repeats")
        discard(spark, path)
        release(spark)
        now, path, length = after, new_path, 2 * length
