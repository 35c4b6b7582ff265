import collections
import os
import random
import re
import sys

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD  # noqa: E402

from tidewater.llm import divergence  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string"


def _terms(text):
    return re.findall(r"[^\x00-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs=30, best=50):
    docs, times, groups = collections.Counter(), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        w = _terms(text)
        docs.update((lang, t) for t in set(w))
        times[lang, source].update(w)
        times[lang, None].update(w)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]

        def share(source):
            c = times[lang, source]
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = share(None)
        p = {s: share(s) for x, s in groups if x == lang}
        for s in p:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if times[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= best]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    vocabulary = [f"{a}{b}" for a in "abcdefg" for b in ("lo", "na", "é", "漢", "RU", "x-y", "Q.")]
    made = []
    for k in range(900):
        lang = "en" if k % 3 else ("de" if k % 2 else None)
        source = r.choice(["s1", "s1", "s1", "s2", "s3", None])
        own = vocabulary[:20] if source == "s2" else vocabulary
        text = " ".join(r.choice(own) + r.choice(["", "", ",", ";more", "-" + r.choice(own)]) for _ in range(r.randrange(0, 60)))
        made.append((k, text, lang, source))
    made += [(2000 + k, made[5][1], "en", "s1") for k in range(300)]                  # copies
    made += [(3000 + k, t, "xx", "odd") for k, t in enumerate(ODD)] + [(1, "alone", "xx", "even"), (1, "alone", "xx", "even")]
    made += [(5000 + k, "12 3.4 --", "yy", f"n{k % 3}") for k in range(40)]            # no terms at all
    return made


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("parts, batch_bytes, cells", [(1, 1 << 20, 10**6), (4, 3000, 50)])
def test_equal_to_brute_force(spark, rows, parts, batch_bytes, cells):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = divergence.audit(df, batch_bytes=batch_bytes, cells=cells)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got(out) == brute(rows)


def test_thresholds_and_ranks(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(divergence.audit(df, min_docs=1, best=3)) == brute(rows, 1, 3)
    assert got(divergence.audit(df, min_docs=10**6)) == brute(rows, 10**6)


def test_empty_table_extra_and_clashing_columns(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(divergence.audit(df.limit(0))) == []
    odd = df.selectExpr("text AS body", "lang AS l", "source AS s", "1 AS batch", "2 AS term", "3 AS value", "4 AS text")
    assert got(divergence.audit(odd, lang="l", source="s", text="body")) == brute(rows)


def test_long_chunks_and_texts(spark):
    made = [(k, "a" * 300_000 + " " + "tiny-Tiny " * 20_000, "en", "s") for k in range(2)] + [(9, "tiny", "en", "t")]
    assert got(divergence.audit(spark.createDataFrame(made, SCHEMA), min_docs=2, batch_bytes=1000)) == brute(made, 2)


def test_terms_of_a_chunk():
    assert divergence.terms_of(pa.array(["(Ab-cD)", "12", "", "é9É", "x"])).to_pylist() == ["ab cd ", "", "", "é É ", "x "]
