"""Language ID: held-out accuracy, spans, and the best path."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from signpost.llm import langid
from signpost.llm.queries import QUERIES

KIND = "doc_id long, text string, lang string, lang_pred int"
WORDS = {
    "en": "the and of to in is that with for on this are was by an be from it as at".split(),
    "fr": "le la les et de des un une que qui dans pour sur avec est pas au ce il elle".split(),
    "ru": "и в не на что он как это по но из у за от так же для мы вы бы".split(),
    "el": "και το να του η της με που την από για είναι στο τα σε οι των ο δεν".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def training(spark, n=80):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, 40), lang, 0) for i, lang in enumerate(sorted(WORDS) * (n // 4))]
    return spark.createDataFrame(rows + [(900, "the le", None, 0), (901, None, "en", 0)], KIND)


def best_path(scores, penalty):
    """All paths' best total, by plain dynamic programming."""
    now = list(scores[0])
    for row in scores[1:]:
        now = [max(now[j], max(now) - penalty) + row[j] for j in range(len(row))]
    return max(now)


def total(scores, path, penalty):
    return scores[np.arange(len(path)), path].sum() - penalty * np.count_nonzero(np.diff(path))


def test_viterbi_is_best():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        scores = -rng.random((n, 4)) * rng.choice([1, 6])
        scores[n // 2 :, 1] += rng.choice([0, 2])
        path = langid.viterbi(scores, 3.0)
        assert abs(total(scores, path, 3.0) - best_path(scores, 3.0)) < 1e-9


def test_spans_of_mixed_text(spark):
    model = langid.train(training(spark))
    assert model.languages == ["el", "en", "fr", "ru"]
    rng = random.Random(7)
    one, other = text(rng, "en", 30), text(rng, "fr", 50)
    rows = [(1, f"{one}. {other}!", None, 0), (2, other.upper(), None, 0), (3, "12 !?", None, 0), (4, None, None, 0), (5, "", None, 0), (5, "", None, 0), (6, "же", None, 0), (7, "漢字", None, 0)]
    got = {r.doc_id: r for r in langid.label(spark.createDataFrame(rows, KIND), model, spans=True).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "fr"] and got[1].lang_pred == "fr"
    assert abs(got[1].spans[1].start - len(one)) < 15 and got[1].spans[0].end == got[1].spans[1].start
    assert got[2].lang_pred == "fr" and got[2].score > 0.9 and got[6].lang_pred == "ru"
    for d in (3, 4, 5):
        assert got[d].lang_pred == "und" and got[d].score == 0 and got[d].n_spans == 0
    assert got[7].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in got.values())


def test_training_leaves_out_held_out(spark):
    rows = [(i, "aa bb", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "yy", 0) for i in range(40)]
    got = langid.labelled(spark.createDataFrame(rows, KIND)).collect()
    assert {r.lang_pred for r in got} == {"yy"}
    assert {r.doc_id for r in got if r.held_out} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}


def test_without_training_and_empty(spark):
    rows = spark.createDataFrame([(1, "some text", None, 0)], KIND)
    assert [r.lang_pred for r in langid.labelled(rows).collect()] == ["und"]
    assert langid.labelled(rows.limit(0)).count() == 0
    assert langid.with_language(rows).count() == 0


def test_with_language_keeps_columns(spark):
    frame = training(spark)
    got = langid.with_language(frame)
    assert got.columns == frame.columns
    assert got.where("lang_pred = 0").count() == frame.count() - 1  # the null text has no language


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    joined = QUERIES["op8_language_id"](spark, sf).join(docs, "doc_id").where("held_out")
    right, count = joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert count > 200 and right > 0.97
