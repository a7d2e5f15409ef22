"""Byte-level BPE and token records against the libraries themselves."""

from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import bpe, files, records

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'!aAbÉé1²　\x1c "), st.characters(exclude_categories=("Cs",))), max_size=60)


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.vocabulary_path()[0]), special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, max_size=6))
def test_bpe_equals_the_rank_library(texts, plain):
    own = bpe.encoder()
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text)
        assert own.decode(ids) == text.encode()


@pytest.fixture(scope="module")
def library():
    """The library's own encoder, unaltered and not shared with the code under test."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(records.VOCABULARY))


SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "word", ".", "<|", "é"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(TEXT, SPECIAL), max_size=6))
def test_cached_library_encoder_equals_the_library(texts, library):
    for text, ids in zip(texts, records.encoder().encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_special_strings_get_their_ids(library):
    text = "hello <|endoftext|> there"
    (ids,) = records.encoder().encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids == [31373, 220, 50256, 612]


def test_op4(spark, docs, nothing, plain):
    got = bpe.encode_documents(docs, keep_ids=True).collect()
    texts = docs.select("doc_id", "text").collect()
    want = sorted(((i, len(ids := plain(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=repr) == want
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe.encode_documents(nothing).count() == 0


def test_op6(spark, folder, docs, nothing, tmp_path, library):
    got = sorted(records.op6_records(spark, folder).collect(), key=lambda r: r.start)
    encode = library.encode
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i))
    assert got[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False))

    def want(i, t):
        ids = [*encode(t or "", add_special_tokens=False).ids, 2]
        return i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted((want(*r) for r in docs.select("doc_id", "text").collect()), key=repr)
    written = records.write_records(docs, str(tmp_path / "small"), file_bytes=2000)
    listed = written.collect()
    assert len(listed) > 4 and sum(r.n_records for r in listed) == docs.count()
    doc_id, offset, n = records.read_index(listed[0]["index"])[-1]
    again = records.read_at(listed[0].data, offset)
    assert (again[0] or 0, len(again[1])) == (doc_id, n)
    assert records.write_records(nothing, str(tmp_path / "none")).count() == 0


def test_damage_is_seen():
    good = records.frame(records.to_payload(7, np.array([1, 2, 3], "<u4"), 2))
    assert records.from_payload(records.read_frame(io.BytesIO(good)))[1].tolist() == [1, 2, 3]
    for at in range(len(good)):
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :]))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(good[:-1]))


def test_unfinished_files_have_no_name(tmp_path):
    with pytest.raises(RuntimeError), files.writing(f"{tmp_path}/x.bin") as f:
        f.write(b"1")
        raise RuntimeError
    assert list(tmp_path.iterdir()) == []
