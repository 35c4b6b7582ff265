"""Benchmark decontamination with one FM-index per shard of training texts.

Benchmark items give search phrases: every ``PHRASE`` consecutive words, or all
words of a shorter item. The words of the phrases are the alphabet. A shard is
a few megabytes of texts in the order they are read; its string is the texts'
words as symbols of that alphabet, where every maximal stretch of other words
is one separator (no phrase can match across it; stretches of alphabet words
shorter than the shortest phrase are left out likewise). Of that string the
shard keeps a BWT as a wavelet matrix with rank counts, and every
``SAMPLE``-th suffix position. All phrases are searched backwards at once, one
array operation per word and bit; matches are located by LF-steps to a sampled
position. Occurrences become word spans, which are merged per document.

No shuffle: shards are cut from the scan's partitions, and the phrases reach
all executors in blocks of at most ``BLOCK_BYTES`` of benchmark text (one
broadcast each, so a large benchmark is searched block by block).

Words: A-Z lower-cased, then runs of digits, a-z and non-ASCII characters.
Defined results: null and empty texts have no words and no hits; items without
words are no phrases; items with equal texts are found together; an empty
benchmark leaves all documents clean; repeated rows get equal results. Columns
of the input are kept; result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm._words import ALNUM, LOWER, chunks, column_bytes, per_text, word_hashes, words

PHRASE = 10
SAMPLE = 8
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word of each text, and where in their text words start and end."""
    raw, bounds = column_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = words(raw, bounds, ALNUM)
    base = bounds[per_text(first)]
    return word_hashes(raw, starts, ends), first, starts - base, ends - base


class Phrases:
    """The search phrases of a block of benchmark items: ``alphabet`` (sorted
    word hashes; symbol k+1 is alphabet[k]), ``groups`` (length, symbols of the
    different phrases) and the items of each phrase."""

    def __init__(self, item_ids: list, texts: list, phrase: int = PHRASE):
        hashes, first, _, _ = _tokens(pa.array(texts, pa.large_string()))
        self.alphabet = np.unique(hashes)
        symbol = np.searchsorted(self.alphabet, hashes).astype(np.int32) + 1
        found: dict[int, dict[bytes, set]] = {}
        for k, item in enumerate(item_ids):
            own = symbol[first[k]:first[k + 1]]
            n = min(phrase, len(own))
            for i in range(len(own) - n + 1 if n else 0):
                found.setdefault(n, {}).setdefault(own[i:i + n].tobytes(), set()).add(item)
        self.groups = []
        for n, phrases in sorted(found.items()):
            self.groups.append((n, np.frombuffer(b"".join(phrases), np.int32).reshape(-1, n), [sorted(s, key=str) for s in phrases.values()]))
        self.shortest = min(found, default=0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in lexical order, by prefix doubling. Symbol 0 ends a
    suffix: separators are told apart by their place, so that the rounds follow
    the longest repeat inside stretches."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    size = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - size] = rank[size:] + 1
        key = rank * (int(second.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        size *= 2
        if rank[order[-1]] == n - 1 or size >= n:
            return order


class WaveletMatrix:
    """Rank and access on a sequence, one bit plane per bit of the symbols."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.planes, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.planes.append((level, ones))
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        lo, hi = np.zeros_like(end), end
        for (level, ones), zeros in zip(self.planes, self.zeros):
            bit = (symbol >> level) & 1
            lo_one, hi_one = ones[lo], ones[hi]
            lo = np.where(bit == 1, zeros + lo_one, lo - lo_one)
            hi = np.where(bit == 1, zeros + hi_one, hi - hi_one)
        return hi - lo

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it occurs before it."""
        symbol, lo, pos = np.zeros_like(at), np.zeros_like(at), at
        for (level, ones), zeros in zip(self.planes, self.zeros):
            bit = ones[pos + 1] - ones[pos]
            symbol |= bit.astype(symbol.dtype) << level
            lo = np.where(bit == 1, zeros + ones[lo], lo - ones[lo])
            pos = np.where(bit == 1, zeros + ones[pos], pos - ones[pos])
        return symbol, pos - lo


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        """``text`` over 0..symbols-1, ending in the separator 0. Besides every
        ``sample``-th position those behind a separator are sampled, so that
        no LF-step leaves a stretch."""
        order = suffix_array(text)
        bwt = text[order - 1]          # the suffix at 0 is preceded by the last symbol, a separator
        self.tree = WaveletMatrix(bwt.astype(np.int64), max(1, int(symbols).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        kept = (order % sample == 0) | (bwt == 0)
        self.sampled_before = np.zeros(len(order) + 1, np.int64)
        np.cumsum(kept, out=self.sampled_before[1:])
        self.samples = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of every pattern (rows of equal length)."""
        last = patterns[:, -1].astype(np.int64)
        lo, hi = self.before[last].copy(), self.before[last + 1].copy()
        for k in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            c = patterns[live, k].astype(np.int64)
            lo[live] = self.before[c] + self.tree.rank(c, lo[live])
            hi[live] = self.before[c] + self.tree.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out = np.full(len(rows), -1, np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            kept = self.sampled_before[at + 1] > self.sampled_before[at]
            out[todo[kept]] = self.samples[self.sampled_before[at[kept]]] + steps
            todo, at = todo[~kept], at[~kept]
            if len(todo):
                c, before = self.tree.symbol_and_rank(at)
                at = self.before[c] + before
                steps += 1
        return out


def shard_occurrences(hashes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every phrase occurrence in a shard: first word, length, group and
    phrase number."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(hashes) or not phrases.groups:
        return none
    k = np.minimum(np.searchsorted(phrases.alphabet, hashes), len(phrases.alphabet) - 1)
    known = phrases.alphabet[k] == hashes
    symbol = np.where(known, k + 1, 0)
    # stretches of alphabet words inside one text that can hold a phrase
    begin = known.copy()
    begin[1:] &= ~known[:-1]
    heads = first[:-1][np.diff(first) > 0]
    begin[heads] |= known[heads]
    at = np.flatnonzero(begin)
    if not len(at):
        return none
    gone = np.flatnonzero(~known)
    stop = np.minimum(np.append(gone, len(known))[np.searchsorted(gone, at)], first[1:][np.searchsorted(first, at, side="right") - 1])
    long_enough = stop - at >= phrases.shortest
    at, stop = at[long_enough], stop[long_enough]
    if not len(at):
        return none
    size = stop - at + 1               # one separator behind each stretch
    place = np.cumsum(size) - size
    origin = np.arange(int(size.sum())) + np.repeat(at - place, size)
    text = symbol[np.minimum(origin, len(symbol) - 1)]
    text[place + size - 1] = 0
    index = FMIndex(text, len(phrases.alphabet) + 1)
    present = np.zeros(len(phrases.alphabet) + 1, bool)
    present[text] = True
    out = []
    for g, (n, patterns, _) in enumerate(phrases.groups):
        possible = np.flatnonzero(present[patterns].all(axis=1))
        if not len(possible):
            continue
        lo, hi = index.search(patterns[possible])
        hits = hi - lo
        rows = np.repeat(lo - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        word = origin[index.locate(rows)]
        out.append((word, np.full(len(word), n), np.full(len(word), g), np.repeat(possible, hits)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else none


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans that may overlap or touch, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(start) - 1)
    return start[fresh], reach[last]


def _scan(phrases: Phrases, text_at: int, schema: pa.Schema, n_kept: int, shard_bytes: int):
    """Adds a block's findings to those of earlier blocks, if there are any."""
    def shard(table: pa.Table) -> list[pa.RecordBatch]:
        table = table.combine_chunks()
        hashes, first, w_start, w_end = _tokens(table.column(text_at))
        word, size, group, number = shard_occurrences(hashes, first, phrases)
        n = table.num_rows
        earlier = "__spans" in table.column_names
        items = table.column("__items").to_pylist() if earlier else [[]] * n
        spans = table.column("__spans").to_pylist() if earlier else [[]] * n
        per_doc = np.searchsorted(first, word, side="right") - 1
        order = np.argsort(per_doc, kind="stable")
        cuts = np.flatnonzero(np.diff(per_doc[order])) + 1
        for own in np.split(order, cuts) if len(order) else []:
            d = int(per_doc[own[0]])
            s = np.concatenate([word[own], [first[d] + x["start"] for x in spans[d]]]).astype(np.int64)
            e = np.concatenate([word[own] + size[own], [first[d] + x["end"] for x in spans[d]]]).astype(np.int64)
            spans[d] = [{"start": int(a - first[d]), "end": int(b - first[d]), "first_byte": int(w_start[a]), "last_byte": int(w_end[b - 1])}
                        for a, b in zip(*merge_spans(s, e))]
            seen = {i for g, k in set(zip(group[own].tolist(), number[own].tolist())) for i in phrases.groups[g][2][k]}
            items[d] = sorted(seen.union(items[d]), key=str)
        hit = [sum(x["end"] - x["start"] for x in s) for s in spans]
        made = [np.diff(first), hit, items, spans]
        columns = [table.column(i).cast(f.type) for i, f in enumerate(schema) if i < n_kept]
        columns += [pa.array(m, f.type) for m, f in zip(made, list(schema)[n_kept:])]
        return pa.Table.from_arrays(columns, schema=schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            _, bounds = column_bytes(batch.column(text_at))
            for i, j in chunks(bounds, shard_bytes):
                part = int(bounds[j] - bounds[i])
                if held and size + part > shard_bytes:
                    yield from shard(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(i, j - i))
                size += part
        if held:
            yield from shard(pa.Table.from_batches(held))

    return run


def _blocks(benchmark: DataFrame, item: str, text: str, phrase: int, block_bytes: int) -> Iterator[Phrases]:
    """Benchmark blocks of bounded size, dealt by a hash of the item."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for b in range(n):
        rows = (benchmark.where(F.pmod(F.xxhash64(F.col(item), F.col(text)), F.lit(n)) == b)
                .select(F.col(item).alias("i"), F.col(text).alias("t")).distinct().orderBy("i", "t").collect())
        yield Phrases([r["i"] for r in rows if r["i"] is not None], [r["t"] for r in rows if r["i"] is not None], phrase)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                       phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids of items with an occurring
    phrase) and spans (word and byte ranges to remove, merged, of the text as
    UTF-8). The blocks of a large benchmark pass over the rows in turn."""
    result = ("n_words", "n_hit", "items", "spans")
    kept = [c for c in docs.columns if c not in result and c != text]
    place = [T.StructField(c, T.LongType()) for c in ("start", "end", "first_byte", "last_byte")]
    found = [T.StructField("__n_words", T.LongType()), T.StructField("__n_hit", T.LongType()),
             T.StructField("__items", T.ArrayType(benchmark.schema[item].dataType)), T.StructField("__spans", T.ArrayType(T.StructType(place)))]
    base = [T.StructField(c, docs.schema[c].dataType) for c in kept] + [T.StructField("__text", T.StringType())]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    blocks = list(_block_parts(benchmark, item_text, block_bytes))
    for i, part in enumerate(blocks):
        phrases = _phrases(part, item, item_text, phrase)
        columns = base if keep_text or i < len(blocks) - 1 else base[:-1]
        schema = T.StructType([*columns, *found])
        out = out.mapInArrow(_scan(phrases, len(kept), to_arrow_schema(schema), len(columns), shard_bytes), schema)
    shown = [F.col(f"`{c}`") if c != text else F.col("__text").alias(text) for c in docs.columns if c in kept or (c == text and keep_text)]
    return out.select(*shown, *[F.col(f"__{c}").alias(c) for c in result])


def _block_parts(benchmark: DataFrame, text: str, block_bytes: int) -> Iterator[DataFrame]:
    """The benchmark in parts of about ``block_bytes``, by a hash of the text."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for b in range(n):
        yield benchmark.where(F.pmod(F.xxhash64(F.col(text)), F.lit(n)) == b)


def _phrases(part: DataFrame, item: str, text: str, phrase: int) -> Phrases:
    """The phrases of a bounded benchmark part; items without id have none."""
    rows = part.where(F.col(item).isNotNull()).select(F.col(item).alias("i"), F.col(text).alias("t")).distinct().collect()
    rows.sort(key=lambda r: (str(r["i"]), r["t"] or ""))
    return Phrases([r["i"] for r in rows], [r["t"] for r in rows], phrase)
