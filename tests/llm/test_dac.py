from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordloom.llm import dac


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.integers(0, 31))
def test_codes_round_trip_and_random_access(values, shift):
    values = np.array(values, np.uint64) >> np.uint64(shift)
    codes = dac.Codes(dac.encode(values))
    assert len(codes) == len(values) and (codes.all() == values).all()
    for i in range(0, len(values), 1 + len(values) // 50):
        assert codes[i] == values[i]
    with pytest.raises(IndexError):
        codes[len(values)]


def test_codes_are_as_long_as_their_levels():
    values = np.arange(300) % 300
    data = dac.encode(values)
    assert len(data) == 12 + (4 + 300 + 38 + 4) + (4 + 44 + 6 + 4)
    with pytest.raises(ValueError):
        dac.Codes(b"none" + data)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return dac.Encoder(None)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(st.sampled_from("aB1.,'!-é日 \n\t\r\x1c\x85　\U0001f600stdlr<|>"), max_size=60), min_size=1, max_size=5))
def test_pieces_make_the_ids_of_whole_texts(tokenizer, encoder, texts):
    got = encoder.encode_all(pa.array(texts))
    assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_in_texts_are_found(tokenizer, encoder):
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|> b  c\n", "<|endoftext |>", "", "plain words."]
    got = [g.tolist() for g in encoder.encode_all(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [87, 220, 50256, 331]


def test_a_tokenizer_with_other_splitting_encodes_whole_texts(tokenizer, tmp_path):
    settings = json.loads(tokenizer.to_str())
    settings["pre_tokenizer"]["use_regex"] = False
    path = str(tmp_path / "other.json")
    Path(path).write_text(json.dumps(settings))
    texts = ["two words, and more. 12", " x", ""]
    other = Tokenizer.from_file(path)
    got = [g.tolist() for g in dac.Encoder(path).encode_all(pa.array(texts))]
    assert got == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_pieces_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(dac, "KNOWN_PIECES", 3)
    monkeypatch.setattr(dac, "SLICE", 20)
    texts = [" ".join(f"word{i + j}, x." for j in range(9)) for i in range(20)]
    got = dac.Encoder(None).encode_all(pa.array(texts))
    assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
@pytest.mark.parametrize("segment", [dac.SEGMENT, 500])
def test_file_round_trip(frame, segment, request, tokenizer, tmp_path):
    docs = request.getfixturevalue(frame)
    path = str(tmp_path / "tokens")
    dac.write_tokens(docs, path, segment=segment)
    found = sorted(dac.read_digests(docs.sparkSession, path).collect(), key=lambda r: r.start)
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, dac.END]
        rows.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    start = 0
    for r in found:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in rows[r.doc_id]
        rows[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert not any(rows.values())
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda i: (i is not None, i or 0))
