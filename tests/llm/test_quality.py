"""Quality rules, language model, language identification."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import language_id, quality_lm, quality_rules
from clickflow.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import EDGE_TEXTS


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, small_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{small_dir}/{table}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, small_dir)
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall())


# --- rules ------------------------------------------------------------------------------------


def measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_of_edges(docs_of):
    rnd = random.Random(4)
    repeated = " ".join(rnd.choice("abc") for _ in range(3000))
    texts = [*EDGE_TEXTS, "a b c a b c a b", "a a a", "a a a a", "x\ny\nx\n\n \nx", repeated, "# a|b <c>"]
    rows = quality_rules.judge(docs_of(*texts)).collect()
    got = {
        r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        for r in rows
    }
    assert got == {i: measures(t) for i, t in enumerate(texts)}
    for r in rows:
        n, _, _, _, repeats = got[r["doc_id"]]
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_host_verdicts_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if i % 10 else "bad", f"h{i % 7}") for i in range(700)]
    rows += [(1000 + i, "bad" if i % 10 else good, "spam") for i in range(200)]
    rows += [(2000, "bad", "one"), (2001, good, "one"), (2002, good, None), (2003, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == len(rows)
    spam = [r for r in got.values() if r["host"] == "spam"]
    assert not any(r["kept"] for r in spam) and any(not r["failed_rules"] for r in spam)
    assert got[2001]["kept"] and got[2001]["host_rate"] < 0.5
    assert got[2002]["kept"] and not got[2003]["kept"]
    assert all(got[i]["kept"] == bool(i % 10) for i in range(700))
    assert quality_rules.judge(docs.limit(0)).collect() == []


# --- language model ---------------------------------------------------------------------------


def kneser_ney(texts):
    """Interpolated modified Kneser-Ney over code points, by its textbook recursion."""
    order = quality_lm.ORDER
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        s = [0] * (order - 1) + [ord(c) + 1 for c in t]
        counts[order].update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    base = 1 / (len(counts[1]) + 1)

    def discount(k):
        n = Counter(counts[k].values())
        if not all(n[i] for i in (1, 2, 3, 4)):
            return lambda c: (0.5, 0.75, 0.9)[min(c, 3) - 1]
        y = n[1] / (n[1] + 2 * n[2])
        d = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
        d = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
        return lambda c: d[min(c, 3) - 1]

    rules = {k: discount(k) for k in range(1, order + 1)}
    after = {k: defaultdict(list) for k in range(1, order + 1)}
    for k in after:
        for g, c in counts[k].items():
            after[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if k == 0:
            return base
        seen = after[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        total = sum(seen)
        gamma = sum(rules[k](c) for c in seen) / total
        c = counts[k].get(g, 0)
        return (max(c - rules[k](c), 0) / total if c else 0) + gamma * p(g[1:])

    def score(t):
        s = [0] * (order - 1) + [ord(c) + 1 for c in t]
        return -sum(math.log(p(tuple(s[i : i + order]))) for i in range(len(t))) / len(t)

    return score


@pytest.mark.parametrize("sent", [0, 200, 1 << 20])
def test_perplexity_equals_the_recursion(spark, small_docs, sent):
    train = [t for _, t in small_docs[:15] if t] + ["日本語のテキスト 🙂🙂", "Привет, мир"]
    tests = [t[:400] for _, t in small_docs[15:25] if t] + ["zzz", "日本", "a", "🙂 мир", "a", "\0\0a", "Ω" * 50]
    rows = [(t, True) for t in train] + [(t, False) for t in tests]
    counts = quality_lm.gram_counts(spark.createDataFrame(rows, "text string, fit boolean").repartition(4))
    logs = quality_lm.log_probabilities(counts)
    score = kneser_ney(train)
    docs = spark.createDataFrame([(i % 3, "x", t) for i, t in enumerate(tests)], "doc_id int, lang string, text string")
    got = quality_lm.perplexity(docs.repartition(3), logs, sent).collect()
    want = sorted((len(t), score(t)) for t in tests)
    assert sorted((r["size"], r["log_perplexity"]) for r in got) == [(n, pytest.approx(x, rel=1e-9)) for n, x in want]


def test_grams_of_pieces_and_wide_alphabets(monkeypatch):
    monkeypatch.setattr(quality_lm, "_SLICE_CHARS", 7)
    wide = "".join(map(chr, range(0x10000, 0x10000 + 70_000)))
    for texts in (["abcabcab" * 5, None, "", "x", "\0\0\0a", "é日🙂\0" * 9], ["ab" * 40, wide]):
        if wide in texts:
            monkeypatch.setattr(quality_lm, "_SLICE_CHARS", 1 << 20)
        got = Counter()
        for pieces in quality_lm._pieces(texts):
            assert sum(len(body) for _, _, body in pieces) <= quality_lm._SLICE_CHARS
            head, tail, place, owner = quality_lm.distinct_grams(pieces)
            assert len(set(zip(head.tolist(), tail.tolist()))) == len(head)
            got.update(zip(owner.tolist(), head[place].tolist(), tail[place].tolist()))
        want = Counter()
        for i, text in enumerate(texts):
            s = [0, 0, 0, *(ord(c) + 1 for c in text or "")]
            want.update((i, s[j - 3] << 21 | s[j - 2], s[j - 1] << 21 | s[j]) for j in range(3, len(s)))
        assert got == want


def test_ranges_and_verdicts_by_brute_force(spark, small_dir, small_docs):
    labels = [tuple(r) for r in spark.read.parquet(f"{small_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    good = {i for i, quality, toxic in labels if quality == 1 and not toxic}
    fit = {i for i in good if zlib.crc32(str(i).encode()) % 2 == 0}
    score = kneser_ney([t for i, t in small_docs if i in fit and t])
    scores = {i: (score(t), len(t)) for i, t in small_docs if t and not t.isspace()}

    def at(values, share):  # the smallest value with that share of all at or below it
        values = sorted(values)
        return values[max(0, math.ceil(share * len(values)) - 1)]

    mid = at([scores[i][0] for i in good - fit if i in scores], 0.5)
    apart = {i: (scores[i][0] - mid) * math.sqrt(scores[i][1]) for i in scores}
    low = at([apart[i] for i in good if i in apart], quality_lm.LOW_QUANTILE)
    high = at([apart[i] for i in good - fit if i in apart], quality_lm.HIGH_QUANTILE)
    assert len(good - fit) < 2 * quality_lm.MIN_TRUSTED  # every language takes the range of all
    got = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, small_dir).collect()}
    assert len(got) == len(small_docs)
    for i, _ in small_docs:
        assert got[i]["kept"] == (i in apart and low - 1e-9 <= apart[i] <= high + 1e-9)
        if i in scores:
            assert got[i]["log_perplexity"] == pytest.approx(scores[i][0], abs=1e-6)


def test_junk_of_other_scripts_is_told_apart(spark):
    rnd = random.Random(8)
    scripts = {"ru": "абвгдежзиклмнопрст", "el": "αβγδεζηθικλμνξοπρσ", "zh": "日本語文字列漢書国人大小中学生年月"}
    rows, labels = [], []
    for lang, letters in scripts.items():
        words = ["".join(rnd.choices(letters, k=rnd.randint(2, 6))) for _ in range(60)]
        for k in range(260):
            clean = k < 220
            text = (
                " ".join(rnd.choices(words, k=120)) if clean else "".join(rnd.choices(letters + " ", k=500))
            )
            rows.append((len(rows), lang, text))
            labels.append((len(labels), int(clean), 0))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r["row"]["doc_id"]: r["kept"] for r in quality_lm.classify(docs, known).collect()}
    for lang in scripts:
        ids = [i for i, own, _ in rows if own == lang]
        assert sum(kept[i] for i in ids if labels[i][1]) >= 0.97 * 220
        assert not any(kept[i] for i in ids if not labels[i][1])


def test_classifier_by_label_and_language(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op8_quality_classifier"](spark, sf_dir)
    joined = got.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").groupBy("quality", "toxic", "lang")
    rows = joined.agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()
    for r in rows:
        if r["quality"] == 1 and not r["toxic"]:
            assert r["kept"] >= 0.98 * r["n"]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in bad) <= 0.05 * sum(r["n"] for r in bad)
    assert all(r["kept"] <= 0.12 * r["n"] for r in bad)


def test_classifier_keeps_clean_text_and_rejects_junk(spark, small_dir):
    got = QUERIES["op8_quality_classifier"](spark, small_dir)
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    rate = {
        r["quality"]: r["kept"]
        for r in got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    }
    assert got.count() == spark.read.parquet(f"{small_dir}/documents.parquet").count()
    assert rate[1] > 0.98 and rate[0] < 0.5


def test_classifier_edges(spark, docs_of):
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(10)] + [(None, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int"
    )
    docs = docs_of(*EDGE_TEXTS, (None, "no id"), (2, "repeated id"))
    rows = quality_lm.classify(docs, labels).collect()
    assert len(rows) == len(EDGE_TEXTS) + 2
    blank = [r for r in rows if not (r["row"]["text"] or "").strip()]
    assert len(blank) == 4 and not any(r["kept"] or r["log_perplexity"] for r in blank)
    nothing = quality_lm.classify(docs, labels.limit(0)).collect()
    assert all(r["kept"] == bool((r["row"]["text"] or "").strip()) for r in nothing)
    assert quality_lm.classify(docs.limit(0), labels).collect() == []


# --- language ---------------------------------------------------------------------------------


def bits(text, sample, block=language_id.BLOCK):
    """Greedy cross-parsing by substring search."""
    sample, text = ("".join(map(chr, language_id._points(t))) for t in (sample, text))
    phrases = 0
    for start in range(0, len(text), block):
        part, i = text[start : start + block], 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in sample:
                j += 1
            i = max(i + 1, j - 1)
            phrases += 1
    return phrases * math.log2(max(2, len(sample))) / len(text)


def test_parsing_equals_brute_force(small_docs):
    texts = [t[:1500] for _, t in small_docs if t][:20] + [t for t in EDGE_TEXTS[:12]]
    samples = language_id.Samples((("a", texts[0]), ("b", texts[1]), ("c", "the cat sat on the mat")))
    found = language_id.costs(texts, language_id.parsers(samples), block=256)
    for text, row in zip(texts, found, strict=True):
        if not text or not any(c.isalpha() for c in text):
            assert np.isnan(row).all()
        else:
            assert row == pytest.approx([bits(text, s, 256) for _, s in samples.texts])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op5_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97


def test_language_edges(spark, docs_of):
    docs = docs_of(*EDGE_TEXTS, (None, "the end"), (3, "the end of it"))
    samples = language_id.fit(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")))
    assert [lang for lang, _ in samples.texts] == ["aa", "bb"]
    rows = language_id.predict(docs, samples).collect()
    assert len(rows) == len(EDGE_TEXTS) + 2
    for r in rows:
        spelled = any(c.isalpha() for c in r["row"]["text"] or "")
        assert (r["lang_pred"] == "und") != spelled and 0 <= r["score"] <= 1
    empty = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(docs, empty).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), samples).collect() == []
    alone = language_id.fit(docs.withColumn("lang", F.lit("xx")))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs_of("abc"), alone).collect()} == {("xx", 1.0)}
