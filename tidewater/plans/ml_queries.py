"""ML on the driver tables (ML1-ML6): documents with quality labels.

Features come from the document text (length, lines, words, language code);
the label is ``labels.quality``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import dict_encode
from ..operators import model as ML
from ..session import read_table
from .registry import query

# Language codes of the document feature.
LANG_CODES = {"en": 0, "fr": 1, "de": 2, "es": 3}
DOC_FEATURES = ["n_chars", "n_lines", "n_words", "lang_code"]


def doc_features():
    """Model features of a document, computed over its whole text."""
    return [
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        dict_encode("lang", LANG_CODES, 4).cast("double").alias("lang_code"),
    ]


def labelled_documents(spark, sf, split_method: str = "mod"):
    return scorable_documents(spark, sf, split_method).where(F.col("quality").isNotNull())


def scorable_documents(spark, sf, split_method: str = "mod"):
    """Every document with its features, and its label where it has one."""
    docs = read_table(spark, sf, "documents")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    j = docs.join(lab, on="doc_id", how="left")
    return j.select(
        "doc_id", "quality", *doc_features(),
        ML.split_flag("doc_id", 80, split_method).alias("split"),
        ML.class_weight("quality", ML.LOAN_POSITIVE_WEIGHT).alias("weight"),
    )


# ---------------------------------------------------------------- ML features over whole texts
@query("doc_features", """
SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
       CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
       CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
       CAST(CASE lower(lang) WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 ELSE 4 END AS DOUBLE) AS lang_code,
       length(text) = n_chars AS length_matches
FROM documents
""", covers="ML1 P10")
def doc_features_query(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", *doc_features(), (F.length("text") == F.col("n_chars")).alias("length_matches"))


# ---------------------------------------------------------------- ML4, ML2, A10
@query("ml_split_summary", """
SELECT CASE WHEN (d.doc_id % 10) * 10 < 80 THEN 'train' ELSE 'validation' END AS split,
       count(*) AS n, CAST(sum(l.quality) AS BIGINT) AS positives,
       avg(CAST(l.quality AS DOUBLE)) AS positive_rate,
       sum(CASE WHEN l.quality = 1 THEN CAST(3 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) AS weight_sum
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
GROUP BY 1
""", covers="ML2 ML4 A10")
def ml_split_summary(spark, sf):
    d = labelled_documents(spark, sf)
    return d.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").cast("bigint").alias("positives"),
                                  F.avg(F.col("quality").cast("double")).alias("positive_rate"),
                                  F.sum("weight").alias("weight_sum"))


# ---------------------------------------------------------------- ML1, ML5, ML6 (rows only: a trained model)
SCORED_AT = "2024-02-01 00:00:00"


@query("doc_quality_scores", None, covers="ML1 ML3 ML5 ML6 P14 P15")
def doc_quality_scores(spark, sf, max_iter: int = ML.GBT_PARAMS["maxIter"]):
    """Train on the labelled training side, take the AUC on the validation
    side, score every document, with the audit columns of a scoring run."""
    d = labelled_documents(spark, sf)
    model = ML.train_gbt(d.where(F.col("split") == "train"), DOC_FEATURES, "quality", weight="weight",
                         maxIter=max_iter)
    auc = ML.auc(model, d.where(F.col("split") == "validation"), "quality")
    scored = ML.score(model, scorable_documents(spark, sf))
    out = ML.scored_audit(ML.loan_labels(ML.fraud_labels(scored)), F.lit(SCORED_AT).cast("timestamp_ntz"))
    return out.select("doc_id", "quality", *DOC_FEATURES, "fraud_score", "label", "confidence", "probability", "risk_level",
                      "recommendation", "scored_at", "date", F.lit(auc).alias("auc"))
