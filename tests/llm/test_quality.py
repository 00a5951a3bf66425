"""The classifier on texts of which the truth is known, and its sampling."""

from __future__ import annotations

import random

import odd

from tarmac.llm import quality


def corpus(n=1500):
    random.seed(2)
    words = [f"w{i}" for i in range(300)]
    data, labels = [], []
    for i in range(n):
        text = random.choices(words, k=random.randint(30, 120))
        kind = "good" if i % 5 else random.choice(["toxic", "junk", "repeated"])
        if kind == "toxic":
            text[3:3] = random.choices(["vile", "nasty"], k=2)
        elif kind == "junk":
            text = [w + "!!" for w in text]
        elif kind == "repeated":
            text = text[:2] * 40
        data.append((i, " ".join(text), "en", "s", 1))
        if i % 2:
            labels.append((i, int(kind not in ("junk", "repeated")), int(kind == "toxic")))
    return data, labels


def test_bad_texts_go_and_good_ones_stay(spark):
    data, labels = corpus()
    rows = quality.resample(odd.frame(spark, data), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(rows) == len(data)
    kept = {r["doc_id"]: r["kept"] for r in rows}
    good, bad = [kept[i] for i in kept if i % 5], [kept[i] for i in kept if i % 5 == 0]
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.05
    stays = quality.keep_good(odd.clashing(odd.frame(spark, data), "log_weight", "kept"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert stays.columns[-2:] == ["log_weight", "kept"] and {r["doc_id"] for r in stays.collect()} == {i for i, k in kept.items() if k}


def test_rare_words_of_a_small_language_tell(spark):
    random.seed(8)
    data, labels, truth = [], [], {}
    for i in range(3000):
        lang = "de" if i % 12 == 0 else "en"
        text = random.choices([f"{lang}{k}" for k in range(400)], k=random.randint(40, 120))
        toxic = random.random() < 0.2
        if toxic:
            text[5:5] = random.sample([f"{lang}vile{k}" for k in range(8)], k=4)
        data.append((i, " ".join(text), lang, "s", 1))
        truth[i] = (lang, toxic, i // 12 % 2 == 0)
        if truth[i][2]:
            labels.append((i, 1, int(toxic)))
    kept = {r["doc_id"]: r["kept"] for r in quality.resample(odd.frame(spark, data), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    for lang in ("en", "de"):
        caught, lost = ([not kept[i] for i, (x, toxic, labelled) in truth.items() if x == lang and toxic == t and not labelled] for t in (True, False))
        assert sum(caught) / len(caught) > 0.9 and sum(lost) / len(lost) < 0.02, lang


def test_odd_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    strange = spark.createDataFrame([(None, 1, 0), (9, None, 0), (12, 1, None), (99999, 1, 0)], "doc_id bigint, quality int, toxic int")
    for labels in (none, strange):
        got = quality.resample(odd.frame(spark), labels).collect()
        assert len(got) == len(odd.rows()) and all(r["kept"] for r in got)
    assert quality.resample(odd.frame(spark, []), none).count() == 0
    assert quality.keep_good(odd.frame(spark), none).count() == len(odd.rows())


def test_kth_largest(spark):
    random.seed(4)
    values = [random.gauss(0, 1) for _ in range(500)] + [1.5] * 20 + [-1e9, 1e9]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 30, 60, 300, len(values)):
        assert quality.kth_largest(frame, "x", k) == ordered[k - 1]
    assert quality.kth_largest(frame, "x", 0) == float("inf")
