import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD  # noqa: E402

from tidewater.llm import language  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 2 = 0")
    return language.fit(docs, sample=60)


def test_held_out_accuracy_of_the_text_alone(spark, model):
    held = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 2 = 1")
    got = language.identify(held, model, declared=None, url=None).select("lang", "language", "rejected").collect()
    assert sum(r.lang == r.language for r in got) / len(got) > 0.99
    assert not any(r.rejected for r in got)


def test_evidence_decides_a_short_text(spark, model):
    rows = [(1, "de", "de", "http://x.de/"), (2, "de", "es", "http://y.es/"), (3, "de", None, None), (4, "1234 5678", "de", "http://x.de/")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    got = {r.doc_id: r for r in language.identify(df, model, url="url").collect()}
    assert got[1].language == "de" and got[2].language == "es" and got[3].language in ("de", "es", "fr")
    assert got[4].rejected and got[4].language == "und"


def test_host_prior_is_smoothed_down_the_levels_without_the_row(spark, model):
    k = len(model.classes)
    post = lambda lang: [10 ** 6 if c == lang else 0 for c in model.classes]
    rows = [("a.x.com", "x.com", "com", post("fr"))] * 200 + [("b.x.com", "x.com", "com", post("en"))] + [("c.org", "c.org", "org", post("en"))] * 50
    df = spark.createDataFrame(rows, "host string, domain string, suffix string, post array<bigint>")
    levels = {r.host: r.levels for r in language.host_counts(df, k).collect()}
    got = {r.host: language.priors(np.array([levels[r.host]]), np.array([r.post]))[0] for r in df.distinct().collect()}

    def want(host, domain, suffix, mine):
        prior = np.full(k, 1 / k)
        for keep in (lambda r: True, lambda r: r[2] == suffix, lambda r: r[1] == domain, lambda r: r[0] == host):
            n = (sum(np.array(r[3]) for r in rows if keep(r)) - np.array(mine)) / 1e6
            prior = (n + language.SMOOTH * prior) / (n.sum() + language.SMOOTH)
        return np.log(prior)

    for r in df.distinct().collect():
        assert np.allclose(got[r.host], want(r.host, r.domain, r.suffix, r.post))
    fr = model.classes.index("fr")
    assert got["a.x.com"][fr] > got["b.x.com"][fr] > got["c.org"][fr]


def test_identify_against_a_plain_version(spark, model):
    """Scores of the text, declared language, suffix and the host's other rows,
    added up one by one."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 2 = 1").limit(60).collect()]
    rows = [(k, t[:40 + 7 * k], ["de", "EN", None, "fr-FR", "xx"][k % 5], ["http://a.x.de/1", "http://b.x.de/", "http://y.fr", "plain", None][k % 5 if k % 7 else 4])
            for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    got = {r.doc_id: r for r in language.identify(df, model, url="url").collect()}
    slim = {r.doc_id: (r.language, r.confidence) for r in language.identify(df, model, url="url", keep_text=False).collect()}
    assert slim == {d: (r.language, r.confidence) for d, r in got.items()}
    classes, k = model.classes, len(model.classes)
    parts = {"http://a.x.de/1": ("a.x.de", "x.de", "de"), "http://b.x.de/": ("b.x.de", "x.de", "de"), "http://y.fr": ("y.fr", "y.fr", "fr"),
             "plain": ("plain", "plain", None), None: (None, None, None)}
    scores = []
    for _, text, lang, url in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        s = model.scores(raw, np.array([0, len(raw)]))[0]
        said = {"de": "de", "EN": "en", "fr-FR": "fr"}.get(lang)
        for value, trust in ((said, language.DECLARED), (parts[url][2], language.SUFFIX)):
            if value in classes:
                s[classes.index(value)] += np.log(trust)
        scores.append(s)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    own = np.array([np.round(soft(s) * 1e6) for s in scores])
    for i, (d, _, _, url) in enumerate(rows):
        prior = np.full(k, 1 / k)
        for level in (None, 2, 1, 0):
            same = [j for j, r in enumerate(rows) if level is None or parts[r[3]][level] == parts[url][level]]
            n = (own[same].sum(axis=0) - own[i]) / 1e6
            prior = (n + language.SMOOTH * prior) / (n.sum() + language.SMOOTH)
        want = soft(scores[i] + np.log(prior))
        assert got[d].language == classes[int(want.argmax())] and abs(got[d].confidence - want.max()) < 1e-6


def test_many_languages(spark):
    names = [f"{a}{b}q" for a in "bcdfghjklm" for b in "aeiou" if a + b != "ba"]       # baq is Basque
    rows = [(k, f"{n} {n[::-1]}{n} " * 6 + str(k), n, f"h{k % 9}") for k, n in enumerate(names * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    many = language.fit(df)
    assert len(many.classes) == len(names) + 2
    got = language.identify(df, many).collect()
    assert sum(r.language == r.lang for r in got) == len(rows)


def test_odd_rows(spark, model):
    rows = [(k, t, None, None, "x") for k, t in enumerate(ODD)] + [(90, "%%% ### 12 34 $$$", "en", "src0", "x"), (91, "the and of " * 40_000, "en", "src0", "x")]
    df = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, lang string, source string, language string")
    out = language.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "language", "confidence", "rejected"]
    got = out.collect()
    assert len(got) == len(rows) + 1
    by = {r.doc_id: r for r in got}
    assert all(by[k].rejected for k in (0, 1, 2, 90)) and not by[91].rejected and by[91].language == "en"
    assert language.identify(df.limit(0), model).count() == 0
    empty = language.fit(df.limit(0))
    assert empty.classes == ["und"]
    assert language.identify(df, empty).where(F.col("rejected")).count() == len(rows) + 1


def test_priors_are_joined_beyond_the_broadcast_bound(spark, model, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(100)
    few = sorted(map(tuple, language.identify(df, model).select("doc_id", "language", "confidence").collect()))
    monkeypatch.setattr(language, "PRIOR_NUMBERS", 1)
    assert sorted(map(tuple, language.identify(df, model).select("doc_id", "language", "confidence").collect())) == few


def test_languages_without_labels_are_kept_and_noise_is_not(spark, model):
    import random
    r = random.Random(5)
    letters = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    clean = {
        1: "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και φεύγει μακριά στο δάσος. " * 3,
        2: "Быстрая коричневая лиса перепрыгивает через ленивую собаку и убегает далеко в лес. " * 3,
        3: "敏捷的棕色狐狸跳过了懒狗，然后跑进了森林里。" * 3, 4: "Nopea ruskea kettu hyppii laiskan koiran yli ja juoksee sitten kauas metsään.",
        5: "Kwa hiyo mbweha mwepesi wa kahawia anaruka juu ya mbwa mvivu na kukimbia mbali msituni.",
        6: "Con cáo nâu nhanh nhẹn nhảy qua con chó lười biếng rồi chạy thật xa vào trong rừng.", 7: "Γεια", 8: "Да"}
    noise = {11: letters("abcdefghijklmnopqrstuvwxyz    ", 2000), 12: letters("0123456789abcdef", 400), 13: "a" * 200, 14: "🙂 → ★ ━━━ • " * 20,
             15: letters("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 600), 16: "\ufffd" * 50, 17: "ж" * 90, 18: "--- 12 x *** 99 %%% $$$"}
    df = spark.createDataFrame([(k, t, None, None) for k, t in {**clean, **noise}.items()], "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in language.identify(df, model).collect()}
    assert {k for k in got if got[k].rejected} == set(noise)
    assert {got[k].language for k in (1, 2, 3)} == {"other"}


def test_labels_are_languages_and_the_most_frequent_are_taken(spark, monkeypatch):
    values = ["EN", "en-US", " eng ", "en_GB.UTF-8", "fil", "haw", "fi", "ger", "DEU", "", "und", "12", None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(language.tag(F.col("v"))).collect()]
    assert got == ["en", "en", "en", "en", "fil", "haw", "fi", "de", "de", None, None, None, None]
    rows = [(f"the cat number {k} and the dog", ("EN", "en-us", "eng")[k % 3]) for k in range(300)]
    rows += [(f"der hund und die katze {k % 20} im haus", "de") for k in range(2000)] + [(f"text {k}", f"zz{chr(97 + k // 26)}{chr(97 + k % 26)}") for k in range(200)] * 2
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    taken = {}
    monkeypatch.setattr(language, "MAX_LABELS", 2)
    monkeypatch.setattr(language, "TextModel", lambda labels, counts: taken.update(zip(labels, counts)))
    language.fit(df, sample=20)
    assert set(taken) == {"en", "de"}
    # twenty different texts of each: every German one has " kat" once, every English one " cat"
    gram = lambda t: language._trigrams(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0][0]
    assert taken["de"][gram(b" ka")] == 20 and taken["en"][gram(b" ca")] == 20
