"""Merkle manifest, secret scans and spelling variants against plain recomputation."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random
import zlib
from collections import Counter
from hashlib import sha256
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import merkle, secrets, spelling
from tests.llm.conftest import EDGE_TEXTS

# --- Merkle manifest --------------------------------------------------------------------------


def digest_of(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest_of(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest_of(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, at):
    path = []
    for level in levels[:-1]:
        start = at - at % 8
        path.append(("".join(level[start:at]), "".join(level[at + 1 : start + 8])))
        at //= 8
    return path


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded, verified of every row, by hand."""
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    sorted_trees = {
        n: sorted(trees[n], key=lambda r: (r["doc_id"] is not None, r["doc_id"], plain_leaf(r, r["text"]))) for n in names
    }
    levels = {n: plain_levels([plain_leaf(r, r["text"]) for r in sorted_trees[n]]) for n in names}
    top = plain_levels([levels[n][-1][0] for n in names])
    out = []
    for place, n in enumerate(names):
        for at, row in enumerate(sorted_trees[n]):
            path = plain_path(levels[n], at) + plain_path(top, place)
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = plain_leaf(row, text)
            for left, right in path:
                folded = digest_of(left, folded, right)
            root = top[-1][0]
            proof = digest_of(*(a + b for a, b in path))
            out.append((row["doc_id"], levels[n][0][at], levels[n][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def checked(docs, tmp_path):
    leaves = merkle.placed_leaves(docs)
    manifest = merkle.write_manifest(leaves, str(tmp_path / "manifest"))
    return sorted((tuple(r) for r in merkle.check_claims(manifest, leaves).collect()), key=repr)


@pytest.mark.parametrize("levels", range(1, 7))
def test_every_node_has_a_place_of_its_own(levels):
    places = np.concatenate([merkle.address(levels, d, np.arange(8**d)) for d in range(levels)])
    assert sorted(places) == list(range(merkle.subtree_size(levels)))


def test_lower_subtrees_lie_together():
    # Four levels are split in half: nine nodes, then 64 subtrees of nine.
    assert merkle.address(4, 0, np.array([0]))[0] == 0
    assert list(merkle.address(4, 1, np.arange(8))) == list(range(1, 9))
    assert list(merkle.address(4, 2, np.arange(64))) == [9 + 9 * i for i in range(64)]
    assert list(merkle.address(4, 3, np.arange(16))) == [10 + i for i in range(8)] + [19 + i for i in range(8)]


def test_manifest_equals_plain_recomputation(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert checked(docs, tmp_path) == plain_manifest([r.asDict() for r in docs.collect()])


def test_several_tiers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 8)
    rows = spark.range(700).selectExpr(
        "id AS doc_id",
        "concat('Text ', id) AS text",
        "CASE WHEN id < 9 THEN NULL WHEN id < 10 THEN '' WHEN id < 100 THEN concat('l', id) ELSE 'en' END AS lang",
        "'s' AS source",
        "id AS n_chars",
    )
    assert checked(rows, tmp_path) == plain_manifest([r.asDict() for r in rows.collect()])


def test_edges_of_the_manifest(spark, docs_of, tmp_path):
    docs = docs_of(*EDGE_TEXTS, (None, "No Id"), (None, None), (3, "Twice"), (3, "Twice"), (3, "twice"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.lit("é")))
    docs = docs.selectExpr("*", "'x' AS tree", "'x' AS pos", "'x' AS digest", "'x' AS root", "'x' AS part")
    got = checked(docs, tmp_path)
    assert got == plain_manifest([r.asDict() for r in docs.collect()])
    assert {len(r[4]) for r in got} == {64}


@pytest.mark.parametrize("count", [0, 1])
def test_no_and_one_document(docs_of, tmp_path, count):
    docs = docs_of("Only ONE").limit(count)
    got = checked(docs, tmp_path)
    assert len(got) == count
    for row in got:
        assert row[1] == row[2] == row[3] and row[4] == sha256(b"").hexdigest()


# --- secrets ----------------------------------------------------------------------------------


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


SECRET = "note: password = hunter2hunter2 end"
LAYERS = {
    "url": quote(SECRET, safe=""),
    "url twice": quote(quote(SECRET, safe="")),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "braces": "".join(f"\\u{{{ord(c):x}}}" for c in SECRET),
    "hex escapes": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "references": "".join(f"&#{ord(c)};" if i % 2 else f"&#x{ord(c):x};" for i, c in enumerate(SECRET)),
    "wide": "".join(chr(ord(c) + 0xFEE0) if c > " " else c for c in SECRET),
    "unseen": "​".join(SECRET),
    "base64": b64(SECRET),
    "url-safe": base64.urlsafe_b64encode(("~~~???" + SECRET).encode()).decode(),
    "unpadded": b64(SECRET).rstrip("="),
    "wrapped": base64.encodebytes(("filler " * 20 + SECRET).encode()).decode(),
    "path": "Bearer/" + b64(SECRET),
    "utf-16": b64(SECRET.encode("utf-16-le")),
    "gzip": b64(gzip.compress(SECRET.encode())),
    "zlib": b64(zlib.compress(SECRET.encode())),
    "bzip2": b64(bz2.compress(SECRET.encode())),
    "xz": b64(lzma.compress(SECRET.encode())),
    "deep": quote(b64("x " + b64(gzip.compress(b64("\\u0070" + SECRET[7:]).encode())))),
    "gzip twice": b64(gzip.compress(zlib.compress(SECRET.encode()))),
}


@pytest.mark.parametrize("name", sorted(LAYERS))
def test_layer_is_opened(name):
    if name == "deep":
        wrapped = quote(b64("x " + b64(gzip.compress(b64("my \\u0070assword = hunter2hunter2 end").encode()))), safe="")
    else:
        wrapped = LAYERS[name]
    text = f"é before {wrapped} after"
    found = secrets.unwrap(text)
    assert not found.base
    spans = {(s, e, k) for s, e, k, _ in found.layered}
    start, end = text.index(wrapped), text.index(wrapped) + len(wrapped)
    assert any(k == "assign" and start <= s < e <= end for s, e, k in spans), found
    assert all(start <= s < e <= end for s, e, _ in spans)


def test_spans_are_mapped_to_what_was_encoded():
    text = f"a {quote('password=')}hunter%32abc b"
    ((start, end, kind, route),) = secrets.unwrap(text).layered
    assert (text[start:end], kind, route) == ("password%3Dhunter%32abc", "assign", "url")
    text = "x " + b64("12345678 token=abcdef99 rest of it")
    ((start, end, _, _),) = secrets.unwrap(text).layered
    assert b"token=abcdef99" in base64.b64decode(text[start - (start - 2) % 4 : end + 3 - (end - 3) % 4] + "==")
    assert end - start < 24


def test_context_beside_an_escape_counts():
    text = "password \\u003d hunter22 and secret%3A%20abcdef and token=abc%64ef"
    found = secrets.unwrap(text)
    assert found.base == []
    assert [text[s:e] for s, e, _, _ in found.layered] == [
        "password \\u003d hunter22", "secret%3A%20abcdef", "token=abc%64ef",
    ]


def plain_base(text):
    """The base spans by the stated patterns, without the shortcuts."""
    import re

    spans = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), m.end(), "assign") for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(spans, key=lambda s: (s[0], order[s[2]]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    parts = ["password", "PASSWD", "secret", "ſecret", "toKen", "api_key", "apikey", "=", ":", " ", '"', "'", "abcdef", "abc",
             "AKIA", "ABCDEFGH12345678", "AKIAAKIA", "0123456789abcdef", "deadbeef", "é", "\n", "-", "%3D", "\\u003d", "K", "🙂"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        found = secrets.unwrap(text)
        assert found.base == plain_base(text), text
        assert set(found.base) <= set(found.spans())


def test_layers_end():
    nested = "password=hunter2hunter2"
    for _ in range(12):
        nested = b64("w " + nested)
    assert secrets.unwrap(nested).layered
    percent = "%"
    for _ in range(30):
        percent = percent.replace("%", "%25")
    assert secrets.unwrap(percent + "41").refused == 0
    again = gzip.compress(b"z" * 40)
    assert secrets.unwrap(b64(again) + " " + b64(again)).layered == []


def test_bombs_stay_shut_and_are_counted(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_UNPACKED", 10_000)
    text = f"{b64(zlib.compress(b'a' * 50_000))} password=hunter2hunter2 {b64(zlib.compress(SECRET.encode()))}"
    found = secrets.unwrap(text)
    assert (found.refused, len(found.base), len(found.layered)) == (1, 1, 1)


def test_scan_keeps_rows_and_clashing_columns(docs_of):
    docs = docs_of(*EDGE_TEXTS, (None, "secret: abcdef1"), (3, "secret: abcdef1")).selectExpr(
        "*", "'x' AS secrets", "'x' AS scanned", "'x' AS n_refused"
    )
    got = secrets.scan(docs).select("row.*", F.size("`secrets`").alias("found")).collect()
    assert len(got) == len(EDGE_TEXTS) + 2
    assert Counter(r["found"] for r in got) == {0: len(EDGE_TEXTS), 1: 2}
    assert secrets.scan(docs.limit(0)).collect() == []


def test_registered_secret_scan_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    small_docs = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in secrets.op12_secret_scans(spark, sf_dir).collect()}
    assert len(got) == len(small_docs)
    assert sum(r["n_assign"] for r in got.values()) > 0
    for doc_id, text in small_docs:
        row, spans = got[doc_id], plain_base(text or "")
        counts = Counter(k for _, _, k in spans)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [counts[k] for k in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        assert row["base_sha256"] == sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))
        assert row["n_refused"] == 0


# --- spelling variants ------------------------------------------------------------------------


def edits(word, alphabet):
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    found |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet}
    found |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return found - {word}


def plain_variants(counts):
    alphabet = {c for w in counts for c in w}
    out = {}
    for word, n in counts.items():
        near = [w for w in edits(word, alphabet) if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[word] = (form, n, len(near), counts.get(form))
    roots = {}
    for word in counts:
        at = word
        while out[at][0] is not None:
            at = out[at][0]
        roots[word] = at
    return sorted((w, f, roots[w], n, k, m) for w, (f, n, k, m) in out.items())


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


@pytest.mark.parametrize("most", [4096, 5, 1])
def test_variants_equal_all_edits(spark, most):
    rng = random.Random(most)
    counts = {}
    for _ in range(900):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        counts[word] = rng.choice([2, 2, 3, 20, 25, 300, 300, 4000])
    counts |= {"aaaaaaaaaaaa": 7, "aaaaaaaaaaa": 70, "aaaaaaaaaa": 700, "bbbbbbbab": 2, "🙂🙂🙂🙂🙂🙂🙂": 30, "🙂🙂🙂🙂🙂🙂": 3}
    assert result(spelling.variants(words_of(spark, counts), most=most)) == plain_variants(counts)


def test_groups_with_more_words_are_cut(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    counts = {f"prefix{a}{b}suffix": 2 for a in letters for b in letters}
    words = words_of(spark, counts)
    sizes = [g.groupBy("key").count().agg(F.max("count")).first()[0] for g in spelling.edit_groups(words, 60)]
    assert max(s or 0 for s in sizes) <= 60
    assert {r["n_near"] for r in spelling.near_words(words, 60).collect()} == {50}


def test_short_words_and_no_words(spark):
    counts = {"a": 5, "ab": 50, "b": 50, "cd": 2, "abc": 500}
    assert result(spelling.variants(words_of(spark, counts))) == plain_variants(counts)
    assert result(spelling.variants(words_of(spark, counts).limit(0))) == []


def plain_vocabulary(rows):
    import re

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_vocabulary_of_edge_texts(docs_of):
    texts = [*EDGE_TEXTS, "ÀÉÎ straßenbahn Straßenbahn STRASSENBAHN ×÷×÷×÷× ×÷×÷×÷×", (None, "Straßenbahn fahren fahrende fahrende")]
    docs = docs_of(*texts).selectExpr("*", "'x' AS word", "'x' AS n")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()} == plain_vocabulary(rows)


def test_registered_variants_equal_all_edits(spark, small_dir, small_docs):
    expected = plain_variants(plain_vocabulary(small_docs))
    assert result(spelling.op13_spelling_variants(spark, small_dir)) == expected
