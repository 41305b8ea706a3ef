"""Token ids against the public libraries, and what is packed and written of them."""

from __future__ import annotations

import base64
import hashlib
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from clickflow.llm import bpe, packing, token_files
from clickflow.llm.queries import QUERIES
from clickflow.llm.tokens import Encoder
from tests.llm.conftest import EDGE_TEXTS

WORD, BYTE, RANKS = (P.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize(("path", "byte_level"), [(WORD, False), (BYTE, True)])
def test_encoder_equals_library(path, byte_level, small_docs):
    texts = [t or "" for t in EDGE_TEXTS] + [t or "" for _, t in small_docs]
    packed = Encoder(path, byte_level).encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == library(path)(texts)


@pytest.mark.parametrize(("path", "byte_level"), [(WORD, False), (BYTE, True)])
def test_added_tokens_equal_the_library_as_loaded(path, byte_level):
    tokenizer = Tokenizer.from_file(path)
    texts = [t or "" for t in EDGE_TEXTS] + [
        "a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|><|endoftext|>\n y  <|endoftext|>", "<|ENDOFTEXT|> <|endoftext| >",
        "ΑΣ<|endoftext|>Σ é <|startoftext|>'s  ", "", "a <|endoftext|>",
    ]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    packed = Encoder(path, byte_level, added=True).encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == expected


def test_bpe_equals_tiktoken_in_any_blocks(docs_of, tik):
    docs = docs_of(*EDGE_TEXTS, *EDGE_TEXTS, (None, "null id"), (None, "null id"), (3, "again 3"))
    expected = sorted(
        ((r["doc_id"], tik.encode_ordinary(r["text"] or "")) for r in docs.collect()), key=repr
    )
    for block_chars in (100, 1 << 20):
        tokens = bpe.encode(docs, RANKS, buckets=5, block_chars=block_chars)
        rows = bpe.decode(tokens, RANKS).collect()
        assert sorted(((r["doc_id"], list(r["ids"])) for r in rows), key=repr) == expected
        assert all(bytes(r["bytes"]) == tik.decode_bytes(r["ids"]) for r in rows)


def test_bpe_query(spark, small_dir, small_docs, tik):
    got = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, small_dir).collect()}
    assert len(got) == len(small_docs)
    for doc_id, text in small_docs:
        ids = tik.encode_ordinary(text or "")
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_no_rows(docs_of):
    assert bpe.decode(bpe.encode(docs_of("x").limit(0), RANKS), RANKS).collect() == []


def check_packing(rows, expected, capacity, end_id, tokens_of):
    """Every id in one piece, gapless windows within the capacity."""
    pieces = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"], tokens_of(r)))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, ids in expected.items():
        at = 0
        for start, length, total, found in sorted(pieces.pop(doc_id)):
            assert start == at and total == len(ids) and length > 0
            assert found == tokens_of.of(ids[start : start + length])
            at += length
        assert at == len(ids)
    assert not pieces
    for members in windows.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def by_ids(row):
    return list(row["ids"])


by_ids.of = list


def by_crc(row):
    return row["ids_crc32"]


by_crc.of = crc


def test_packing_query(spark, small_dir, small_docs):
    rows = QUERIES["op9_packing"](spark, small_dir).collect()
    ids = [i + [1] for i in library(WORD)([t or "" for _, t in small_docs])]
    expected = dict(zip((d for d, _ in small_docs), ids, strict=True))
    windows = check_packing(rows, expected, 2048, 1, by_crc)
    assert sum(map(len, ids)) / (windows * 2048) > 0.95


def test_packing_edges(docs_of):
    docs = docs_of(*EDGE_TEXTS)
    rows = packing.pack(docs, WORD, end_id=7, capacity=64, rest_tokens=32, block_pieces=8).collect()
    ids = [i + [7] for i in library(WORD)([t or "" for t in EDGE_TEXTS])]
    check_packing(rows, dict(enumerate(ids)), 64, 7, by_ids)
    assert packing.pack(docs.limit(0), WORD, end_id=7).collect() == []
    twice = docs_of((None, "a b"), (None, "a b")).collect()
    assert len(twice) == 2


def test_differencing_is_a_partition_and_near_equal():
    sizes = list(np.random.default_rng(3).integers(1, 512, 400))
    groups = packing.differencing(sizes, 50)
    assert sorted(i for g in groups for i in g) == list(range(400))
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) < 0.05 * np.mean(sums)
    assert packing.differencing([], 1) == []
    assert packing.differencing([5], 3)[0] == [0]


def test_windows_rise_when_capacity_is_exceeded():
    groups = packing.fit_windows([6, 6, 6], 10)
    assert sorted(map(len, groups)) == [1, 1, 1]
    assert packing.fit_windows([10] * 5, 10) and len(packing.fit_windows([10] * 5, 10)) == 5


def test_token_files_query(spark, small_dir, small_docs):
    rows = sorted(QUERIES["op10_token_files"](spark, small_dir).collect(), key=lambda r: r["doc_id"])
    docs = sorted(small_docs)
    start = 0
    for row, ids in zip(rows, library(BYTE)([t or "" for _, t in docs]), strict=True):
        ids = ids + [2]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_edges_and_selective_reads(spark, docs_of, tmp_path):
    import pyarrow.parquet as pq

    texts = [(i if i != 3 else None, t) for i, t in enumerate(EDGE_TEXTS)] + [(5, "five again")]
    path = str(tmp_path / "t")
    token_files.write_token_files(docs_of(*texts), path, BYTE, end_id=2)
    places = token_files.read_places(spark, path).orderBy("start").collect()
    keys = [r["doc_id"] for r in places]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(keys) == len(texts)
    total = 0
    for r in places:
        assert r["start"] == total
        total += r["n_tokens"]
    some = token_files.read_tokens(spark, path, low=5, high=7)
    assert sorted(r["doc_id"] for r in some.collect()) == [5, 5, 6, 7]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,5), LessThanOrEqual(doc_id,7)]" in plan
    meta = token_files.read_places(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids#" not in meta.split("ReadSchema")[0]
    for file in (tmp_path / "t").glob("*.parquet"):
        ids = pq.ParquetFile(file).metadata.row_group(0).column(2)
        assert ids.has_offset_index and ids.has_column_index
        assert any("DICTIONARY" in e for e in ids.encodings)
    empty = str(tmp_path / "e")
    token_files.write_token_files(docs_of("x").limit(0), empty, BYTE, end_id=2)
    assert token_files.token_digests(spark, empty).collect() == []


@pytest.mark.parametrize(("path", "byte_level"), [(WORD, False), (BYTE, True)])
def test_code_points_newer_than_this_python(path, byte_level):
    """Alone and between letters: all code points that Python's tables lack up to U+10FFF, and a share of the others."""
    found = [c for c in range(0x11000) if unicodedata.category(chr(c)) == "Cn" or c % 11 == 0 and not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}" for c in found]
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    packed = Encoder(path, byte_level, added=True).encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == expected


def test_added_tokens_outlive_a_full_memo(monkeypatch):
    monkeypatch.setattr("clickflow.llm.tokens.MEMO_WORDS", 3)
    enc = Encoder(WORD, False, added=True)
    first = enc.encode(["some words <|endoftext|> here \u0558", "and more of them"])
    assert enc.encode(["some words <|endoftext|> here \u0558", "and more of them"]) == first
