"""Language ID by Bayesian evidence fusion.

The posterior of a row's language combines, as log-odds that are added up,

- the text: a multinomial model of letter trigrams per language; a uniform one,
  the class ``other``, for languages without labelled rows; and the class
  ``und`` for what is no language, which the uniform model explains as well and
  which needs evidence of noise: signs, repeated letters, changes between
  letters and digits or into capitals, few vowels in plain ASCII letters;
- the declared language (markup or metadata), trusted ``DECLARED`` times as
  much as any other language;
- the address suffix of the host (``.de``), likewise ``SUFFIX`` times;
- the host: languages of its other rows, by grouped aggregation of the rows'
  posteriors without this evidence. The prior of a host is smoothed with the prior of its
  domain, that with the suffix's, and that with the whole table's, each with
  ``SMOOTH`` pseudo-rows.

Labels and declared languages are compared by their language alone (``tag``):
``EN``, ``en-US`` and ``eng`` are ``en``; ``fil`` is not ``fi``. The text model
is fitted on a bounded sample: at most ``SAMPLE`` different texts per language,
those of least hash, whole, for the ``MAX_LABELS`` languages of the most
different texts, with ``MIN_TEXTS`` at least. Everything else covers all rows. Counts are held by one row per host;
up to ``PRIOR_NUMBERS`` numbers they are broadcast, beyond that joined.

A row is rejected if ``und`` is its most likely class: no letters, or evidence
of noise. A text that no language model explains is ``other`` and stays. A confident decision between
languages is not asked for, so short clean texts stay.

Defined results: null, empty and letterless texts are ``und`` and rejected,
whatever else is known; null declared language, url or source count as no
evidence; an empty table gives no rows; without labelled rows every text that
has letters is decided by the other evidence. Input columns stay; result
columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm._store import settle, small_batches
from tidewater.llm._words import chunks, column_bytes, given_back

UND = "und"
OTHER = "other"              # letter texts that no language model explains
SAMPLE = 400                 # labelled rows per language that the text model is fitted on
BUCKETS = 1 << 16            # of hashed trigrams
DECLARED, SUFFIX = 20.0, 5.0
SMOOTH = 10.0
NOISE = 0.01                 # share of texts that are in no language, before any evidence
TEXT_WEIGHT = 0.3            # neighbouring trigrams share letters, so they count less than independent ones
MAX_LABELS = 200             # languages that are modelled, those of the most texts
MIN_TEXTS = 2                # different texts that a language needs (about); documents of others can be ``other``
SLICE_BYTES = 256 << 10      # text that is scored at once
PRIOR_NUMBERS = 2_000_000    # broadcast with the hosts' counts, at most

#: languages whose usual country suffix says something (fixed values)
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en", "us": "en", "au": "en"}

#: languages by ISO 639-1 code, with their ISO 639-2/3 codes (fixed values)
_CODES = """aa:aar ab:abk ae:ave af:afr ak:aka am:amh an:arg ar:ara,arb as:asm av:ava ay:aym az:aze ba:bak be:bel bg:bul bi:bis bm:bam bn:ben
bo:bod,tib br:bre bs:bos ca:cat ce:che ch:cha co:cos cr:cre cs:ces,cze cu:chu cv:chv cy:cym,wel da:dan de:deu,ger dv:div dz:dzo ee:ewe el:ell,gre
en:eng eo:epo es:spa et:est,ekk eu:eus,baq fa:fas,per,pes ff:ful fi:fin fj:fij fo:fao fr:fra,fre fy:fry ga:gle gd:gla gl:glg gn:grn gu:guj gv:glv
ha:hau he:heb,iw hi:hin ho:hmo hr:hrv ht:hat hu:hun hy:hye,arm hz:her ia:ina id:ind,in ie:ile ig:ibo ii:iii ik:ipk io:ido is:isl,ice it:ita
iu:iku ja:jpn jv:jav,jw ka:kat,geo kg:kon ki:kik kj:kua kk:kaz kl:kal km:khm kn:kan ko:kor kr:kau ks:kas ku:kur kv:kom kw:cor ky:kir la:lat
lb:ltz lg:lug li:lim ln:lin lo:lao lt:lit lu:lub lv:lav,lvs mg:mlg mh:mah mi:mri,mao mk:mkd,mac ml:mal mn:mon mr:mar ms:msa,may,zsm mt:mlt
my:mya,bur na:nau nb:nob nd:nde ne:nep,npi ng:ndo nl:nld,dut nn:nno no:nor nr:nbl nv:nav ny:nya oc:oci oj:oji om:orm or:ori,ory os:oss pa:pan
pi:pli pl:pol ps:pus pt:por qu:que rm:roh rn:run ro:ron,rum,mo,mol ru:rus rw:kin sa:san sc:srd sd:snd se:sme sg:sag si:sin sk:slk,slo sl:slv
sm:smo sn:sna so:som sq:sqi,alb sr:srp,scc ss:ssw st:sot su:sun sv:swe sw:swa,swh ta:tam te:tel tg:tgk th:tha ti:tir tk:tuk tl:tgl tn:tsn
to:ton tr:tur ts:tso tt:tat tw:twi ty:tah ug:uig uk:ukr ur:urd uz:uzb ve:ven vi:vie vo:vol wa:wln wo:wol xh:xho yi:yid,ji yo:yor za:zha
zh:zho,chi,cmn zu:zul"""
SHORT = {long: short for short, _, longs in (pair.partition(":") for pair in _CODES.split()) for long in longs.split(",")}

# bytes of a word for the model: letters and non-ASCII bytes; anything else is a blank
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_VOWEL = np.zeros(256, bool)
_VOWEL[[*b"aeiouyAEIOUY"]] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def _trigrams(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams that lie inside one text and are not blank in the
    middle, and the text of each."""
    b = _FOLD[raw].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(0x9E3779B1)
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    use = np.flatnonzero((b[1:-1] != 0x20) & (owner[:-2] == owner[2:]))
    return (code[use] >> np.uint32(16)).astype(np.int64), owner[use]


def _symbols(raw: np.ndarray) -> np.ndarray:
    """Bytes of non-ASCII characters that are no letters: Latin-1 signs,
    punctuation, arrows to dingbats, CJK punctuation, emoji, U+FFFD."""
    out = np.zeros(len(raw) + 4, bool)
    x = np.concatenate([raw, np.zeros(4, np.uint8)])
    a, b, c = x[:-4], x[1:-3], x[2:-2]
    for lead, size in (((a == 0xC2) & (b != 0xAA) & (b != 0xB5) & (b != 0xBA), 2), ((a == 0xE2) & (b < 0xB0), 3), ((a == 0xE3) & (b == 0x80), 3),
                       ((a == 0xEF) & (b == 0xBF) & (c == 0xBD), 3), ((a == 0xF0) & (b == 0x9F), 4)):
        at = np.flatnonzero(lead)
        for k in range(size):
            out[at + k] = True
    return out[:len(raw)]


def _noise(raw: np.ndarray, owner: np.ndarray, n: int, n_letters: np.ndarray) -> np.ndarray:
    """Log-evidence that letters are no language, per text."""
    count = lambda where: np.bincount(owner[where], minlength=n)
    upper, lower = (raw >= 0x41) & (raw <= 0x5A), (raw >= 0x61) & (raw <= 0x7A)
    digit, letter = (raw >= 0x30) & (raw <= 0x39), upper | lower
    plain, vowels = count(letter), count(_VOWEL[raw])
    out = vowels * np.log(0.23 / 0.38) + (plain - vowels) * np.log(0.77 / 0.62)    # letters at random against a language
    out[n_letters > 1.02 * plain] = 0.0                      # vowels with accents are not counted
    change = np.flatnonzero(lower[:-1] & upper[1:] | letter[:-1] & digit[1:] | digit[:-1] & letter[1:]) if len(raw) > 1 else np.zeros(0, np.int64)
    change = change[owner[change] == owner[np.minimum(change + 1, len(raw) - 1)]]
    out = np.maximum(out, 0.0) + np.log(3.0) * np.maximum(0.0, count(change) - n_letters / 5)
    again = np.zeros(len(raw), bool)
    for lag in range(1, 5):                                  # a character or two, over and over
        same = np.zeros(len(raw), bool)
        same[lag:] = (raw[lag:] == raw[:-lag]) & (owner[lag:] == owner[:-lag]) if len(raw) > lag else False
        for k in (1, 2, 3):                                  # seven or more in a row
            same[k:] &= same[:-k].copy()
        again |= same
    again &= _FOLD[raw] != 0x20
    return out + np.log(3.0) * np.maximum(0.0, count(again) - n_letters / 2)


class TextModel:
    """Log-probabilities of trigrams per class; the last classes are ``other``
    (without any language, it is missing) and ``und``."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        """``counts``: of every hashed trigram, per language."""
        self.classes = [*languages, *[OTHER] * bool(languages), UND]
        table = np.empty((len(self.classes), BUCKETS), np.float32)
        for k, own in enumerate(counts):
            own = own + 0.05
            table[k] = np.log(own / own.sum())
        table[len(languages):] = -np.log(BUCKETS)
        self.table = table

    def scores(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Weighted log-likelihood of each class for each text. Signs between
        letters are evidence for ``und`` only where letters are rare; a text
        without letters is certainly ``und``."""
        n = len(bounds) - 1
        code, owner = _trigrams(raw, bounds)
        out = np.empty((n, len(self.classes)))
        for k in range(len(self.classes)):
            out[:, k] = np.bincount(owner, weights=self.table[k][code], minlength=n) * TEXT_WEIGHT
        symbols = _symbols(raw)
        letters = np.concatenate([[0], np.cumsum((_FOLD[raw] != 0x20) & ~symbols)])
        signs = np.concatenate([[0], np.cumsum(_SIGN[raw] | symbols & (raw >= 0xC0))])
        n_letters = letters[bounds[1:]] - letters[bounds[:-1]]
        n_signs = signs[bounds[1:]] - signs[bounds[:-1]]
        if OTHER in self.classes:
            out[:, -2:] += np.log(NOISE)
            out[:, -1] += np.log(NOISE) + _noise(raw, np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds)), n, n_letters)
        out[:, :-1] -= np.log(3.0) * np.maximum(0, n_signs - 3 * n_letters)[:, None]
        out[n_letters == 0, :-1] = -np.inf
        out[n_letters == 0, -1] = 0.0
        return out


def tag(value: Column) -> Column:
    """The language of a label or of a declared value: its primary subtag in
    lower case, as ISO 639-1 where that has it; null if it names none."""
    primary = F.lower(F.regexp_extract(value.cast("string"), r"^\s*([A-Za-z]+)(?:[-_@.].*)?\s*$", 1))
    short = F.element_at(F.create_map(*[F.lit(x) for pair in SHORT.items() for x in pair]), primary)
    return F.when((primary != "") & ~primary.isin(UND, OTHER, "mul", "mis", "zxx"), F.coalesce(short, primary))


def fit(rows: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> TextModel:
    """The model of a bounded sample: per language up to ``sample`` different
    texts, those of least hash. A first pass counts different texts (about, by
    sketches); the second goes on with texts whose hash lies under what about
    1.5 times the sample needs. Their trigrams are counted where they are; the
    driver gets at most ``BUCKETS`` numbers per language."""
    known = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(tag(F.col(label)).alias("l"), F.col(text).alias("t")).where("l IS NOT NULL")
    most = known.groupBy("l").agg(F.approx_count_distinct(F.xxhash64("t")).alias("n")).where(F.col("n") >= MIN_TEXTS)
    found = {r["l"]: r["n"] for r in most.orderBy(F.desc("n"), "l").limit(MAX_LABELS).collect()}
    labels = sorted(found)
    counts = np.zeros((len(labels), BUCKETS), np.int64)
    if labels:
        shares = F.create_map(*[F.lit(x) for lang, n in found.items() for x in (lang, min(1.0, 1.5 * sample / n))])
        part = F.xxhash64("t").bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") / F.lit(2.0 ** 32)
        near = known.withColumn("h", part).where(F.col("h") < F.coalesce(F.element_at(shares, F.col("l")), F.lit(0.0))).distinct()
        first = near.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))).where(F.col("r") <= sample)
        table = (first.select("l", "t").mapInArrow(_count_trigrams, "l string, bucket int, n long")
                 .groupBy("l", "bucket").agg(F.sum("n").alias("n")).toArrow())
        place = {lang: k for k, lang in enumerate(labels)}
        at = np.array([place[x] for x in table.column("l").to_pylist()], np.int64)
        counts[at, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return TextModel(labels, counts)


@given_back
def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, all_bounds = column_bytes(whole.column(1))
        for i, j in chunks(all_bounds, SLICE_BYTES):
            batch = whole.slice(i, j - i)
            code, owner = _trigrams(*column_bytes(batch.column(1)))
            own = batch.column(0).dictionary_encode()
            pairs, n = np.unique(own.indices.to_numpy()[owner].astype(np.int64) * BUCKETS + code, return_counts=True)
            yield pa.RecordBatch.from_arrays([own.dictionary.take(pa.array(pairs // BUCKETS)), pa.array((pairs % BUCKETS).astype(np.int32)),
                                              pa.array(n, pa.int64())], names=["l", "bucket", "n"])


def _softmax(scores: np.ndarray) -> np.ndarray:
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True)


def _bonus(values: list, classes: list[str], trust: float, names: dict[str, str] | None = None) -> np.ndarray:
    """Log-evidence per row and class of declared values; zero for unknown ones."""
    place = {c: k for k, c in enumerate(classes) if c not in (UND, OTHER)}
    at = [place.get((names or {}).get(v) if names else v, -1) for v in values]
    out = np.zeros((len(at), len(classes)))
    known = np.flatnonzero(np.array(at, np.int64) >= 0)
    out[known, np.array(at, np.int64)[known]] = np.log(trust)
    return out


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(values.reshape(-1), kind))


def _score(model: TextModel, schema: pa.Schema, n_kept: int):
    """Of rows that end with suffix, declared language and text: the first
    ``n_kept`` columns, the scores of all evidence but the host, and their
    posterior in millionths."""
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, all_bounds = column_bytes(whole.column(whole.num_columns - 1))
            for i, j in chunks(all_bounds, SLICE_BYTES):
                batch = whole.slice(i, j - i)
                suffix, said, text = batch.columns[-3:]
                scores = model.scores(*column_bytes(text))
                scores += _bonus(said.to_pylist(), model.classes, DECLARED) + _bonus(suffix.to_pylist(), model.classes, SUFFIX, SUFFIXES)
                own = np.round(_softmax(scores) * _UNIT).astype(np.int64)
                kept = [batch.column(c).cast(f.type) for c, f in enumerate(list(schema)[:n_kept])]
                text = [text.cast(schema.field("__text").type)] if "__text" in schema.names else []
                yield pa.RecordBatch.from_arrays([*kept, *text, _lists(scores, pa.float64()), _lists(own, pa.int64())], schema=schema)

    return run


def priors(levels: np.ndarray, own: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log-prior of rows by class, of the other rows' posteriors: the table's,
    smoothed with equal shares, smooths the suffix's, that the domain's, and that
    the host's. ``levels`` are their sums (rows, 4, classes), of each of which
    the row's ``own`` is taken."""
    prior = np.full(own.shape, 1.0 / own.shape[1])
    for level in range(levels.shape[1]):
        others = (levels[:, level] - own) / _UNIT
        prior = (others + smooth * prior) / (others.sum(axis=1, keepdims=True) + smooth)
    return np.log(prior)


def _decide(classes: list[str], schema: pa.Schema):
    """Rows that end with scores, own posterior and levels: their language."""
    k = len(classes)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, own, levels = batch.columns[-3:]
            scores = pc.list_flatten(scores).to_numpy().reshape(-1, k)
            own = pc.list_flatten(own).to_numpy().reshape(-1, k)
            levels = pc.list_flatten(pc.list_flatten(levels)).to_numpy().reshape(-1, 4, k)
            post = _softmax(scores + priors(levels, own))
            best = post.argmax(axis=1)
            names = pa.array(classes).take(pa.array(best))
            kept = [batch.column(c).cast(f.type) for c, f in enumerate(list(schema)[:-3])]
            yield pa.RecordBatch.from_arrays([*kept, names, pa.array(post[np.arange(len(best)), best]), pc.equal(names, UND)], schema=schema)

    return run


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (its last two labels) and suffix (its last) of a url, or
    of a bare name, which is a host without a suffix."""
    host = F.lower(F.when(url.contains("://"), F.regexp_extract(url, r"://([^/?#:]*)", 1)).otherwise(url))
    labels = F.split(host, r"\.")
    dotted = F.size(labels) > 1
    suffix = F.when(dotted, F.element_at(labels, -1))
    return host, F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host), suffix


#: posteriors are added as millionths, so that sums do not depend on their order
_UNIT = 1_000_000


def host_counts(rows: DataFrame, k: int) -> DataFrame:
    """One row per host: the sums of its rows' posteriors (millionths, by
    class), and those of its domain, its suffix and the whole table. Only
    classes that a row has something of are summed, by (host, class), so a host
    of a third of all rows is a few rows per task."""
    parts = (rows.select("host", "domain", "suffix", F.posexplode("post").alias("i", "n")).where("n > 0")
             .groupBy("host", "domain", "suffix", "i").agg(F.sum("n").alias("n")))
    parts, _ = settle(parts, "host-counts")

    def level(*keys: str) -> DataFrame:
        own = parts.groupBy(*keys, "i").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("m"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("long")))
        return own.select(*keys, dense.alias("n"))

    whole = level().first()                             # one number per class
    table = F.array(*[F.lit(n).cast("long") for n in (whole["n"] if whole else [0] * k)])
    h, d, s = level("host", "domain", "suffix").alias("h"), level("domain").alias("d"), level("suffix").alias("s")
    return (h.join(d, F.expr("h.domain <=> d.domain")).join(s, F.expr("h.suffix <=> s.suffix"))
            .select("h.host", F.array(table, F.col("s.n"), F.col("d.n"), F.col("h.n")).alias("levels")))


def identify(rows: DataFrame, model: TextModel, text: str = "text", declared: str | None = "lang", url: str | None = "source",
             keep_text: bool = True) -> DataFrame:
    """``rows`` with language, confidence, and rejected."""
    small_batches(rows.sparkSession)
    classes, k = model.classes, len(model.classes)
    result = ("language", "confidence", "rejected")
    kept = [c for c in rows.columns if c not in result and c != text]
    none = F.lit(None).cast("string")
    host, domain, suffix = host_parts(F.col(f"`{url}`").cast("string") if url else none)
    said = tag(F.col(f"`{declared}`")) if declared else none
    levels = [host.alias("__host"), domain.alias("__domain"), suffix.alias("__suffix")]

    def scored(columns: list[str], with_text: bool) -> DataFrame:
        base = rows.select(*[F.col(f"`{c}`") for c in columns], *levels, said.alias("__said"), F.col(f"`{text}`").alias("__text"))
        n = len(columns) + 3
        schema = T.StructType([*base.schema.fields[:n], *base.schema.fields[n + 1:] * with_text, T.StructField("__scores", T.ArrayType(T.DoubleType())),
                               T.StructField("__own", T.ArrayType(T.LongType()))])
        return base.mapInArrow(_score(model, to_arrow_schema(schema), n), schema)

    if keep_text:
        first, full = scored([], False), scored(kept, True)
    else:
        # without the text the scores are small: the text is read once
        first = full = settle(scored(kept, False), "language-scores")[0]
    narrow = first.select(F.col("__host").alias("host"), F.col("__domain").alias("domain"), F.col("__suffix").alias("suffix"), F.col("__own").alias("post"))
    counts, _ = settle(host_counts(narrow, k), "host-priors")
    few = counts.limit(PRIOR_NUMBERS // (4 * k) + 1).count() <= PRIOR_NUMBERS // (4 * k)
    counts = counts.withColumnRenamed("host", "__p_host")
    full = full.join(F.broadcast(counts) if few else counts, F.col("__host").eqNullSafe(F.col("__p_host")))
    columns = [T.StructField(c, rows.schema[c].dataType) for c in kept] + [T.StructField("__text", T.StringType())] * keep_text
    schema = T.StructType([*columns, T.StructField("__language", T.StringType()), T.StructField("__confidence", T.DoubleType()), T.StructField("__rejected", T.BooleanType())])
    done = full.select(*[F.col(f"`{c.name}`") for c in columns], "__scores", "__own", "levels").mapInArrow(_decide(classes, to_arrow_schema(schema)), schema)
    shown = [F.col(f"`{c}`") if c != text else F.col("__text").alias(text) for c in rows.columns if c in kept or (c == text and keep_text)]
    return done.select(*shown, *[F.col(f"__{c}").alias(c) for c in result])
