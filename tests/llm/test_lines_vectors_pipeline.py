"""Line dedup and vector search against brute force; the pipeline as a whole."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clickflow.llm import line_dedup, vector_search
from tests.llm.conftest import EDGE_TEXTS


# --- lines ------------------------------------------------------------------------------------


def signed(h):
    return h - 2**64 if h >> 63 else h


def simhash(words):
    bits = [0] * 64
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        for b in range(64):
            bits[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if bits[b] > 0)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def removed_by_brute_force(docs, percent=90, distance=3):
    """Removed line numbers by doc_id, for rows (doc_id, text) with distinct ids."""
    places = []
    for doc_id, text in docs:
        for no, line in enumerate((text or "").split("\n")):
            clean = re.sub(r"[^\w\n]|_", " ", line.lower())
            clean = " ".join(clean.split())
            if len(clean.split()) >= 5:
                places.append((doc_id, no, clean))
    lines = sorted({c for _, _, c in places})
    at = {c: c for c in lines}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    hashes = {c: simhash(c.split()) for c in lines}
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if (hashes[a] ^ hashes[b]).bit_count() <= distance and find(a) != find(b):
                longest = max(len(a), len(b))
                if edit_distance(a, b) <= longest * (100 - percent) // 100:
                    at[find(b)] = find(a)
    groups = defaultdict(list)
    for doc_id, no, clean in places:
        groups[find(clean)].append((doc_id, no))
    gone = defaultdict(set)
    for members in groups.values():
        for doc_id, no in sorted(members)[1:]:
            gone[doc_id].add(no)
    return {d: sorted(s) for d, s in gone.items()}


def varied(seed, copies):
    rnd = random.Random(seed)
    base = [f"word{rnd.randrange(1000)}" for _ in range(40)]
    out = []
    for _ in range(copies):
        words = list(base)
        words[rnd.randrange(40)] = f"other{rnd.randrange(1000)}"
        out.append(" ".join(words))
    return out


def test_lines_equal_brute_force(docs_of):
    rnd = random.Random(8)
    lines = [*varied(1, 40), *varied(2, 30), *("the same line of words here" for _ in range(5))]
    lines += ["short line", "short line", "The SAME line, of words here!", "w " * 200 + "end", "w " * 200 + "end."]
    lines += [" ".join(f"u{rnd.randrange(9**9)}" for _ in range(12)) for _ in range(30)]
    rnd.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5 + 1)]
    got = line_dedup.removed_lines(docs_of(*docs)).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == removed_by_brute_force(docs)


def edited(rnd, words):
    """The words with one word replaced, put in or left out, or one letter changed; close to them in edit distance."""
    i = rnd.randrange(len(words))
    letters = "".join(rnd.choice("abcdefghij") for _ in words[i])
    return rnd.choice(
        [
            [*words[:i], letters, *words[i + 1 :]],
            [*words[:i], "of", *words[i:]],
            [*words[:i], *words[i + 1 :]],
            [*words[:i], words[i][:-1] + "q", *words[i + 1 :]],
        ]
    )


def test_lines_with_one_edit_are_found_at_any_length(docs_of):
    rnd = random.Random(5)
    docs, gone = [], {}
    for low, high in [(5, 15), (9, 14), (16, 30), (31, 80), (81, 120)]:
        end = len(docs) + 120
        while len(docs) < end:
            words = ["".join(rnd.choice("klmnopqrst") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(low, high))]
            one, two = " ".join(words), " ".join(edited(rnd, words))
            if one != two and len(two.split()) >= 5 and edit_distance(one, two) <= max(len(one), len(two)) // 10:
                gone[len(docs) + 1] = [0]
                docs += [(len(docs), one), (len(docs) + 1, two)]
    got = line_dedup.removed_lines(docs_of(*docs), distance=None).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == gone


def test_a_fraction_of_the_lines_that_share_a_half_is_compared(docs_of, monkeypatch):
    rnd = random.Random(9)

    def words(n):
        return ["".join(rnd.choice("klmnopqrst") for _ in range(6)) for _ in range(n)]

    half, docs = words(24), []
    for _ in range(150):
        rest = words(24)
        docs += [half + rest, [*half, *rest[:9], *words(1), *rest[10:]]]
    sizes = []
    write = line_dedup.written

    def counting(df, label, *columns):
        table = write(df, label, *columns)
        if label == "near-lines":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(line_dedup, "written", counting)
    got = line_dedup.removed_lines(docs_of(*((i, " ".join(d)) for i, d in enumerate(docs))), distance=None).collect()
    assert {r["doc_id"] for r in got} == set(range(1, 300, 2))
    # 44,850 pairs share the half; the limit of the open bucket lets 6,202 pass, which still grows with their square.
    assert len(sizes) == 2 and sum(sizes) < 44850 // 5


def test_candidates_meet_their_texts_in_rounds(docs_of, monkeypatch):
    rnd = random.Random(11)

    def words(n):
        return ["".join(rnd.choice("klmnopqrst") for _ in range(6)) for _ in range(n)]

    half, docs = words(24), []
    for _ in range(30):
        rest = words(24)
        docs += [half + rest, [*half, *rest[:9], *words(1), *rest[10:]]]
    monkeypatch.setattr(line_dedup, "ROUND_MEMBERS", 0.5)
    monkeypatch.setattr(line_dedup, "ROUND_PAIRS", 0.5)
    labels = []
    write = line_dedup.written

    def counting(df, label, *columns):
        labels.append(label)
        return write(df, label, *columns)

    monkeypatch.setattr(line_dedup, "written", counting)
    got = line_dedup.removed_lines(docs_of(*((i, " ".join(d)) for i, d in enumerate(docs))), distance=None).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == {i: [0] for i in range(1, 60, 2)}
    # The open bucket of the half is compared in rounds, and so are its pairs and those with the smallest member.
    assert labels.count("near-lines") > 2 and labels.count("similar-lines") > 3


def test_simhash_is_the_majority(spark):
    sizes = [1, 2, 3, 5, 126, 500, 33_000]
    words = {n: [f"w{i % 977}" for i in range(n)] for n in sizes}
    df = spark.createDataFrame([(n, w) for n, x in words.items() for w in x], "n long, word string").repartition(3)
    got = line_dedup._simhash(df.withColumnRenamed("n", "key"), "key").collect()
    assert {r["key"]: r["simhash"] for r in got} == {n: signed(simhash(w)) for n, w in words.items()}


def test_blocks_lose_no_near_pair(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        h = rnd.getrandbits(64)
        g = h
        for b in rnd.sample(range(64), 3):
            g ^= 1 << b
        rows += [(i, signed(h)), (i, signed(g))]
    keys = spark.createDataFrame(rows, "pair long, simhash long").select(
        "pair", "simhash", F.explode(F.array(*line_dedup._keys())).alias("key")
    )
    shared = keys.groupBy("pair", "key").count().where("count > 1").select("pair").distinct().count()
    assert shared == 300


def test_lines_of_edges(docs_of):
    long = "one two three four five six"
    texts = [*EDGE_TEXTS, long, f"{long}\n{long}\nshort", (None, long), (None, long)]
    docs = docs_of(*texts)
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == len(texts) and rows[0].asDict().keys() == set(docs.columns)
    by_id = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(EDGE_TEXTS):
        assert by_id[i]["text"] == text
    n = len(EDGE_TEXTS)
    assert by_id[n]["text"] == long
    assert (by_id[n + 1]["text"], by_id[n + 1]["n_chars"]) == ("short", 5)
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["", ""]
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="distance"):
        line_dedup.line_groups(docs, distance=4)


def test_line_columns_may_have_any_names_and_emptied_documents_go(docs_of):
    long = "one two three four five six"
    clashing = [f"'x' AS `{c}`" for c in ("_doc", "_hash", "_removed", "removed", "gone_doc", "doc", "hash", "words")]
    docs = docs_of(long, f"{long}\n  \n", f"{long}\nshort", "", None).selectExpr("*", *clashing)
    rows = line_dedup.dedup_lines(docs).collect()
    assert rows[0].asDict().keys() == set(docs.columns) and len(rows) == 5
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, drop_emptied=True).collect()}
    assert kept == {0: long, 2: "short", 3: "", 4: None}


def test_nothing_but_the_result_stays_on_disk(spark, docs_of):
    from clickflow.scratch import shared_root

    root = Path(shared_root(spark).removeprefix("file://"))
    before = set(root.iterdir())
    rows = line_dedup.removed_lines(docs_of(*["one two three four five six"] * 4, "w " * 30), distance=None)
    assert rows.count() == 3
    left = {p.name.rpartition("-")[0] for p in set(root.iterdir()) - before}
    assert left == {"lines", "line-groups"}


def test_line_query_counts_rows_without_an_id(spark, docs_of, tmp_path):
    long = "one two three four five six"
    docs_of((1, long), (None, f"{long}\nshort"), (2, "short")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = line_dedup.op2_line_dedup(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["n_lines"], r["n_removed"], tuple(r["removed"])) for r in rows} == {
        (1, 1, 0, ()), (None, 2, 1, (0,)), (2, 1, 0, ()),
    }


def test_lines_of_scripts_without_spaces(docs_of):
    rnd = random.Random(6)

    def line(first, last, n):
        return "".join(chr(rnd.randint(first, last)) for _ in range(n))

    docs, gone = [], {}
    for script in [(0x4E00, 0x9FA5), (0x3041, 0x3096), (0x0E01, 0x0E2E), (0x20000, 0x2A6D0)]:
        for n in (10, 11, 12, 40):
            one = line(*script, n)
            docs += [(len(docs), one), (len(docs) + 1, one), (len(docs) + 2, line(*script, 1) + one[1:])]
            gone[len(docs) - 2] = gone[len(docs) - 1] = [0]
    docs += [(len(docs), "日本語テスト"), (len(docs) + 1, "日本語テスト")]
    docs += [(len(docs), "three longish words"), (len(docs) + 1, "three longish words")]
    got = line_dedup.removed_lines(docs_of(*docs), distance=None).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == gone


def test_no_python_in_the_line_plans(docs_of):
    plan = line_dedup.removed_lines(docs_of("a b c d e f"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_large_open_bucket_is_compared_in_blocks(spark):
    rows = [(-5, i, i % 4) for i in range(23)] + [(7, i, 0) for i in (3, 30, 31)] + [(9, 40, 0)]
    members = spark.createDataFrame(rows, "key long, id long, component long").repartition(3)
    condition = F.col("component") != F.col("component_b")
    got = line_dedup.bucket_pairs(members, condition, block_members=4)
    pairs = [(r["a"], r["b"]) for r in got.collect()]
    want = [(a, b) for k, a, c in rows for l, b, d in rows if k == l and a > b and c != d]
    assert sorted(pairs) == sorted(want)
    # The bucket of 23 is dealt into six blocks: no join group holds all of it.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "i_b" in plan and "j_b" in plan


# --- vectors ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, vector string, cell string, score string"


def brute_nearest(vectors, queries, k):
    """k best by (product, smaller id) in double precision."""
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids], dtype=np.float32).astype(np.float64)
    out = {}
    for q in queries:
        scores = (matrix * matrix[ids.index(q)]).sum(axis=1)
        ranked = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)
        out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_nearest_recall(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 32))
    vectors = {
        i: (centres[i % 12] + 0.4 * rng.standard_normal(32)) * np.exp(spread * rng.standard_normal())
        for i in range(1500)
    }
    df = frame_of(spark, [(i, [float(x) for x in v]) for i, v in vectors.items()])
    got = vector_search.nearest(df, F.col("vec_id") % 50 == 0, k=10, cell_rows=150).collect()
    want = brute_nearest(vectors, range(0, 1500, 50), 10)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found.keys() == want.keys() and all(len(v) == 10 for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.95
    for q, hits in found.items():
        exact = dict(brute_nearest(vectors, [q], 1500)[q])
        assert all(s == exact[i] for i, s in hits)
        assert hits == sorted(hits, key=lambda x: (-x[1], x[0]))


def test_vectors_at_the_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [0.0, 0.0]), (102, [nan, 1.0]), (103, [inf, 1.0]), (104, [None, 1.0]), (105, []), (None, [1.0, 2.0])]
    same = [(i, [1.0, 2.0]) for i in range(60)] + [(7, [1.0, 2.0])]
    df = frame_of(spark, [*bad, *same, (200, [3.0, -1.0])])
    rows = vector_search.nearest(df, F.col("vec_id") % 50 == 0, k=20, cell_rows=16).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert found.keys() == {0, 50, 200}
    assert found[0] == [(i, i, 5.0) for i in range(1, 21)]
    assert found[50] == [(i + 1, i, 5.0) for i in range(20)]
    assert found[200] == [(i + 1, i, 1.0) for i in range(20)]
    few = vector_search.nearest(frame_of(spark, [(0, [1.0]), (1, [2.0])]), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in few] == [(0, 1, 1, 2.0)]
    assert vector_search.nearest(df.limit(0), F.col("vec_id") == 0).collect() == []
    with pytest.raises(ValueError, match="cannot be compared"):
        vector_search.nearest(frame_of(spark, [(0, [1.0]), (1, [2.0, 1.0])]), F.col("vec_id") == 0)


def test_vectors_whose_squares_underflow(spark):
    tiny = [(i, [1e-200 * (i + 1), 1e-200]) for i in (0, 3)]
    rows_ = [*tiny, *((i, [float(i), 1.0]) for i in range(10, 40))]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = vector_search.nearest(df, F.col("vec_id") % 20 == 0, k=3, cell_rows=8).collect()
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}
    assert {q for q, _ in found} == {0, 20}
    assert [found[20, i][0] for i in (1, 2, 3)] == [39, 38, 37]
    assert [found[0, i][0] for i in (1, 2, 3)] == [39, 38, 37] and found[0, 1][1] == 39e-200 + 1e-200


def test_chi_square():
    rng = np.random.default_rng(0)
    sample = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for x in (2.0, 7.3, 15.5):
        assert vector_search.chi_square(np.array([x]))[0] == pytest.approx((sample < x).mean(), abs=0.01)
    assert vector_search.chi_square(np.array([vector_search.stop_factor(0.99)]))[0] == pytest.approx(0.99)


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
            docs = spark.createDataFrame(out.collect(), docs.schema)
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    # Line dedup leaves out documents all of whose lines go.
    assert counts[1] < counts[0] and counts[4] < counts[3] <= counts[2]
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    windows = defaultdict(int)
    for r in rows:
        assert len(r["ids"]) == r["length"]
        windows[r["sequence_id"]] += r["length"]
    assert max(windows.values()) <= 2048
    whole = corpus_pipeline.run(spark, small_dir)
    assert whole.count() == len(rows)
