"""Packing, token files and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from forgemeter.llm import idfiles, packing, tokencount, tokens
from tests.llm.conftest import ODD_TEXTS

PIECES = ["a", "é", "th", " ", "  ", "\n", "'", "'ll", "'re", "'s", ",", "5", "½", "—", "İ", "̱",
          "\xa0", " ", "<|endoftext|>", "<|", "日", "%%%", "I", "²", "_"]
MIXED = st.lists(st.sampled_from(PIECES), max_size=14).map("".join)


def library(name):
    return Tokenizer.from_file(tokens.tokenizer_path(name))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [packing.TOKENIZER, idfiles.TOKENIZER])
def test_units_give_the_ids_of_the_library(name):
    tokenizer, own = library(name), tokens.UnitEncoder(tokens.tokenizer_path(name), keep_units=50)
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    texts += ODD_TEXTS
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
    assert got == [ids_of(tokenizer, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(MIXED)
def test_counts_of_all_prefixes(text):
    tokenizer = library(tokencount.TOKENIZER)
    own = tokencount.counter(tokens.tokenizer_path(tokencount.TOKENIZER))
    want = [len(ids_of(tokenizer, text[:i])) for i in range(len(text) + 1)]
    assert own.table(text).tolist() == want
    assert own.total(text) == want[-1]
    for limit in (1, 3):
        fits = max(i for i, n in enumerate(want) if n <= limit)
        assert own.longest_prefix(text, limit) == fits


def brute_pieces(rows, window):
    tokenizer, at, out = library(packing.TOKENIZER), 0, []
    for doc_id, text in rows:
        ids = np.array([*ids_of(tokenizer, text), 1], dtype="<u4")
        start = 0
        while start < len(ids):
            sequence, offset = divmod(at + start, window)
            length = min(window - offset, len(ids) - start)
            crc = zlib.crc32(ids[start : start + length].tobytes())
            out.append((doc_id, start, length, crc, len(ids), sequence, offset))
            start += length
        at += len(ids)
    return out


def in_order(frame):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    low = lambda v, least: (v is not None, least if v is None else v)
    return sorted(rows, key=lambda r: (low(r[0], 0), low(r[1], "")))


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_packing_of_odd_documents(odd_documents):
    pieces = packing.pack(odd_documents, window=64)
    got = sorted(map(tuple, pieces.select(*COLUMNS).collect()), key=lambda r: r[5:])
    assert got == brute_pieces(in_order(odd_documents), 64)
    rows = packing.sequences(pieces, window=64).orderBy("sequence_id").collect()
    assert [r.filled for r in rows[:-1]] == [64] * (len(rows) - 1)
    assert all(len(r.ids) == 64 for r in rows)
    assert pieces.filter("cut_before <> (start > 0) or cut_after <> (start + length < doc_tokens)").isEmpty()


def test_packing_nothing(no_documents):
    assert packing.pack(no_documents).isEmpty()


def test_token_files_round_trip(odd_documents, folder):
    path = tokens.tokenizer_path(idfiles.TOKENIZER)
    manifest = idfiles.write_ids(odd_documents, f"file://{folder}/ids", path, 2, shard_ids=500)
    got = idfiles.read_ids(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
    at, want, tokenizer = 0, [], library(idfiles.TOKENIZER)
    for doc_id, text in in_order(odd_documents):
        ids = np.array([*ids_of(tokenizer, text), 2], dtype="<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert manifest.count() > 2
    shard = idfiles.read_shard(manifest.orderBy("part", "shard").first().path)
    assert shard.document(shard.n_docs - 1).tolist()[-1] == 2


def test_token_files_of_nothing(no_documents, folder):
    path = tokens.tokenizer_path(idfiles.TOKENIZER)
    manifest = idfiles.write_ids(no_documents, f"file://{folder}/none", path, 2)
    assert idfiles.read_ids(manifest).isEmpty()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=1500).map(sorted))
def test_elias_fano(values):
    code = idfiles.EliasFano.of(np.array(values, dtype=np.int64))
    again, size = idfiles.EliasFano.from_bytes(memoryview(code.to_bytes()))
    assert again.values().tolist() == values and size == len(code.to_bytes())
    for k in range(0, len(values), max(1, len(values) // 20)):
        assert again.select(k) == values[k]


def test_token_counts(odd_documents, no_documents):
    path = tokens.tokenizer_path(tokencount.TOKENIZER)
    tokenizer = library(tokencount.TOKENIZER)
    rows = tokencount.count_tokens(odd_documents, path, limit=10).collect()
    want = sorted(
        (repr(d), len((t or "").encode()), len(ids_of(tokenizer, t))) for d, t in in_order(odd_documents)
    )
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 10) for r in rows)
    assert tokencount.count_tokens(no_documents, path).isEmpty()


def test_ids_beyond_16_bits(spark, folder):
    vocabulary = {"[UNK]": 0, "\x00": 1, "end": 2} | {f"w{i}": i for i in range(3, 70_000)}
    tokenizer = Tokenizer(models.WordLevel(vocabulary, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = f"{folder}/large.json"
    tokenizer.save(path)
    texts = {1: "w3 w69999 w65536 w4", 2: "w65535 w66000"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = {i: [*ids_of(tokenizer, t), 2] for i, t in texts.items()}
    sums = {i: zlib.crc32(np.array(ids, dtype="<u4").tobytes()) for i, ids in want.items()}
    pieces = packing.pack(docs, 100, path, 2)
    assert {r.doc_id: r.ids_crc32 for r in pieces.collect()} == sums
    assert packing.sequences(pieces, 10).first().ids == [*want[1], *want[2], 0, 0]
    manifest = idfiles.write_ids(docs, f"file://{folder}/large", path, 2)
    assert {r.doc_id: r.ids_crc32 for r in idfiles.read_ids(manifest).collect()} == sums
