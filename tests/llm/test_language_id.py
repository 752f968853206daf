from __future__ import annotations

import random
import zlib

import numpy as np

from barmart.llm import language_id

from .conftest import SCHEMA, doc_row

SYLLABLES = {"en": "th er ing on and re sh".split(), "de": "ei sch ung ver zu ä ö".split(), "fr": "eau è oi qu ai ç le".split()}


def made(rng, lang, words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(words))


def rows_of():
    rng = random.Random(3)
    rows = [doc_row(k, made(rng, lang := rng.choice(list(SYLLABLES))), lang) for k in range(400)]
    return rows + [doc_row(1000, None), doc_row(1001, "12 34!"), doc_row(1002, ""), doc_row(None, made(rng, "fr"), "fr"), doc_row(1003, "a", None), rows[0]]


def test_held_out_accuracy_and_defined_cases(spark):
    rows = rows_of()
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    named = [r for r in held if r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang_pred == truth[r.doc_id] for r in named) >= 0.97 * len(named)
    odd = {r.doc_id: r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)}
    assert set(odd.values()) == {"und"}


def test_reruns_agree(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    first, second = (sorted(map(str, language_id.identify(df.repartition(n)).collect())) for n in (2, 7))
    assert [x[:60] for x in first] == [x[:60] for x in second]


def test_kernel_counts_common_grams():
    letters = language_id.letter_table()
    rows, good = language_id.presence(["abc abd", "xyz", "123", None, "abc abd"], letters)
    assert good.tolist() == [True, True, False, False, True]
    model = language_id.Classifier(np.packbits(rows[[0, 1]].astype(bool), axis=1), ["p", "q"])
    near = model.kernels(rows)
    assert np.isclose(near[0, 0], 1) and near[0, 1] < 0.5 and np.isclose(near[4, 0], 1) and near[2].max() == 0


def test_nothing_to_learn_from(spark, no_docs):
    df = spark.createDataFrame([doc_row(1, "abc", None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language_id.identify(df).collect()] == [("und", 0.0)]
    assert language_id.identify(no_docs).collect() == []


def test_repeated_ids_and_copies_fill_no_sample(spark):
    rng = random.Random(4)
    hot = made(rng, "de")
    rows = [doc_row(1, made(rng, lang), lang) for lang in SYLLABLES for _ in range(60)] + [doc_row(1, hot, "de")] * 500
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sample = language_id.training_sample(df, 40).collect()
    assert len(sample) == len(set(sample)) == 120
    assert len(language_id.training_sample(df, 40, 30).collect()) == 30
    got = language_id.identify(df).collect()
    assert sum(r.lang_pred == "und" for r in got) == 0
    model = language_id.fit(df)
    assert len(model.langs) == 3


def test_every_language_is_learnt(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    kinds = {f"l{k:02d}": ["".join(rng.choices(letters, k=4)) for _ in range(12)] for k in range(70)}
    rows = []
    for k, (lang, words) in enumerate(kinds.items()):
        for j in range(8 if k < 6 else 20):
            rows.append(doc_row(len(rows), " ".join(rng.choices(words, k=25)), lang))
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.99 * len(got)
    few = [r for r in got if truth[r.doc_id] < "l06"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in few) >= 0.95 * len(few)


def test_prediction_equals_kernel_ridge_over_sets(spark):
    """The same regression from Python sets of slots and the full kernel formula, one text at a time."""
    rng = random.Random(8)
    texts, langs = zip(*[(made(rng, lang, 6), lang) for lang in list(SYLLABLES) * 12])
    letters = language_id.letter_table()
    sets = [set(language_id.gram_slots(t, letters).tolist()) for t in texts]

    def kernel(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    rows, _ = language_id.presence(list(texts), letters)
    model = language_id.Classifier(np.packbits(rows.astype(bool), axis=1), list(langs))
    order = [i for c in sorted(SYLLABLES) for i in range(36) if langs[i] == c]
    near = np.array([[kernel(sets[i], sets[j]) for j in order] for i in range(36)])
    target = np.array([[float(langs[i] == c) for c in sorted(SYLLABLES)] for i in range(36)])
    left = near.T @ near + language_id.RIDGE * (near[order] + np.eye(36))
    values = near @ np.linalg.solve(left, near.T @ target)
    best, score = model.predict(rows)
    assert best.tolist() == values.argmax(1).tolist()
    assert np.allclose(score, np.clip(values.max(1), 0, 1), atol=2e-3)
