import collections
import hashlib
import zlib
from array import array
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.data import docs, prose, rows
from zonepulse.llm import bpe_transducer, orc_tokens, packing, tokens

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(alphabet=st.sampled_from("ab é\n\t  日本'sllré🙂\x1c\xa0 Σς=-12\0theQ"), max_size=60)


@lru_cache
def library(name, plain=False):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    if plain:
        t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


WORD, BYTE = library("word_bpe_49k.json"), library("byte_bpe_50k.json")
PATHS = {n: public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
OWN = {n: tokens.LibraryEncoder(path) for n, path in PATHS.items()}
PLAIN = {n: tokens.LibraryEncoder(public_tokenizers.path(n), plain=True) for n in OWN}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_transducer.read_ranks(MULTI), special_tokens={})
ENCODER, DECODER = bpe_transducer.Encoder(MULTI), bpe_transducer.Decoder(MULTI, block=3)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_chunks_give_the_ids_of_the_whole_text(text):
    assert list(array("I", OWN["word_bpe_49k.json"].encode(text))) == WORD(text)
    assert list(array("I", OWN["byte_bpe_50k.json"].encode(text))) == BYTE(text)


MARKED = st.text(alphabet=st.sampled_from("abÀß×÷é\u030cJ\n\t .,;:!?'s  \x85\xa0\u2003\u3000日Σς3\0-"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, MARKED, st.sampled_from(["", "<|endoftext|>", "a<|StartOfText|>b."])), max_size=8), st.integers(0, 3), st.integers(1, 60))
def test_texts_encoded_together_have_the_ids_of_each(texts, skip, size):
    for name in OWN:
        for own, plain in ((OWN, False), (PLAIN, True)):
            tokens._AT_ONCE, before = size, tokens._AT_ONCE
            made = list(own[name].encode_all(pa.array(texts, pa.string())[skip:]))
            tokens._AT_ONCE = before
            assert [list(array("I", x)) for x in made] == [library(name, plain)(t) for t in texts[skip:]]


def test_a_word_is_learned_once_for_all_its_marks(monkeypatch):
    for name, path in PATHS.items():
        encoder, merged = tokens.LibraryEncoder(path), []
        monkeypatch.setattr(encoder, "merge", lambda text, merge=encoder.merge: merged.append(text) or merge(text))
        texts = [" ".join(w + m for m in ["", *tokens._MARKS, ".,"]) for w in ("flimble", "gréva")]
        made = list(encoder.encode_all(pa.array(["x " + t for t in texts * 50])))
        assert [list(array("I", x)) for x in made] == [library(name)("x " + t) for t in texts * 50]
        assert sum("flimble" in m for m in merged) == 1 and len(encoder.chunks) <= 2 + 2 + len(tokens._MARKS) + 1 + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|StartOfText|>", "<|startoftext|>", "<|end", " ", "a b", "é", "\n", "Word's", "日本"]), max_size=8))
def test_strings_of_special_tokens(parts):
    text = "".join(parts)
    for name in OWN:
        assert list(array("I", OWN[name].encode(text))) == library(name)(text)
        assert list(array("I", PLAIN[name].encode(text))) == library(name, True)(text)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_transducer_agrees_with_tiktoken_and_decodes(text):
    ids = list(array("I", ENCODER.encode(text)))
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert DECODER.decode(ids) == text


def test_transducer_on_long_pieces_and_after_forgetting(monkeypatch):
    monkeypatch.setattr(bpe_transducer, "MAX_STATES", 50)
    small = bpe_transducer.Encoder(MULTI)
    for text in ("a" * 5000, prose(300, 5).replace(" ", ""), "=" * 3000, "日本" * 500):
        assert list(array("I", small.encode(text))) == TIKTOKEN.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, MARKED, st.sampled_from(["", "<|endoftext|>", "=" * 300 + "ab" * 90])), max_size=8), st.integers(0, 3), st.integers(1, 60), st.integers(1, 9))
def test_transducer_on_texts_together(texts, skip, size, emit):
    before = tokens._AT_ONCE, bpe_transducer._EMIT, bpe_transducer.HEAD
    tokens._AT_ONCE, bpe_transducer._EMIT, bpe_transducer.HEAD = size, emit, emit
    try:
        ENCODER.machine._forget()
        for memory in (ENCODER.chunks, ENCODER.pieces):
            memory.clear()
            memory.before = {}
        made = list(ENCODER.encode_all(pa.array(texts, pa.string())[skip:]))
    finally:
        tokens._AT_ONCE, bpe_transducer._EMIT, bpe_transducer.HEAD = before
        ENCODER.machine._forget()
    assert [list(array("I", x)) for x in made] == [TIKTOKEN.encode_ordinary(t or "") for t in texts[skip:]]


def test_new_words_need_no_new_states_and_are_learned_once_for_all_their_marks(monkeypatch):
    encoder, met = bpe_transducer.Encoder(MULTI), []
    monkeypatch.setattr(encoder, "ids", lambda piece, ids=encoder.ids: met.append(piece) or ids(piece))
    parts = ["blor", "wheti", "zanqu", "dreth", "ciónj", "eaux", "keitor", "umph", "grév", "stiel", "axono", "ripfl"]
    words = [a + b + c + d for a in parts for b in parts for c in parts for d in parts[:4]]
    texts = ["x " + " ".join(w + m for w in words for m in ("", *tokens._MARKS))] * 2
    made = list(encoder.encode_all(pa.array(texts)))
    assert [list(array("I", x)) for x in made] == [TIKTOKEN.encode_ordinary(t) for t in texts]
    assert len(met) <= len(words) + 1 + len(tokens._MARKS)
    assert len(encoder.machine.states) + len(encoder.machine.moves) < len(words) / 2


def test_ids_as_text_in_blocks():
    ids = list(range(9, 120, 7)) * 3
    for block in (1, 4, 7, 1000):
        assert b"".join(bpe_transducer.Decimal(200, block).pieces(array("I", ids))) == ",".join(map(str, ids)).encode()
    assert not list(bpe_transducer.Decimal(200).pieces(array("I")))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.integers(1, 7))
def test_utf8_machine(data, size):
    machine = bpe_transducer.Utf8Machine()
    made = "".join(machine.feed(data[i : i + size]) for i in range(0, len(data), size)) + machine.end()
    try:
        assert made == data.decode()
    except UnicodeDecodeError:
        assert "�" in made


def test_round_trip_query(spark):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_transducer.round_trip(docs(spark)).collect())
    want = []
    for i, text, *_ in rows():
        ids = TIKTOKEN.encode_ordinary(text or "")
        want.append((i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe_transducer.round_trip(docs(spark, [])).count() == 0
    texts = bpe_transducer.decode(bpe_transducer.encode(docs(spark))).collect()
    assert sorted(r.text for r in texts) == sorted(t or "" for _, t, *_ in rows())


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=6), st.integers(0, 60))
@settings(max_examples=300, deadline=None)
def test_closest_fill_is_the_best(counts, target):
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * i for s in sums for i in range(k + 1)}
    used = packing.closest(counts, target)
    assert all(0 < k <= counts[n] for n, k in used.items())
    assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= target)


@pytest.mark.parametrize("capacity,block", [(2048, 2_000_000), (64, 100)])
def test_packing(spark, capacity, block):
    packed = packing.pack(docs(spark).repartition(2), capacity=capacity, block=block).collect()
    sizes, seen = collections.defaultdict(list), collections.defaultdict(list)
    for r in packed:
        sizes[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
        seen[r.doc_id].append((r.start, r.ids))
    for pieces in sizes.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and at & (at - 1) == 0  # full, or a power of two
    for i, text, *_ in rows():
        ids = array("I", [*WORD(text), 1]).tobytes()
        if i is not None and i != 2:
            assert b"".join(p for _, p in sorted(seen[i])) == ids
    assert sum(len(p) for _, p in seen[2]) == 2 * len(array("I", [*WORD(rows()[1][1]), 1]).tobytes())
    assert packing.pack(docs(spark, [])).count() == 0


def test_orc_files(spark, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write(docs(spark), path, parts=3)
    found = sorted(orc_tokens.digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id or 0 for r in found] == sorted(i or 0 for i, *_ in rows())
    stored = {(r.part, r.place): r for r in orc_tokens.read(spark, path).collect()}
    in_files = [zlib.crc32(array("I", stored[k].ids).tobytes()) for k in sorted(stored)]
    assert [r.ids_crc32 for r in found] == in_files
    at, want = 0, collections.Counter((i, zlib.crc32(array("I", [*BYTE(t), 2]).tobytes())) for i, t, *_ in rows())
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in found) == want
    one = orc_tokens.read(spark, path).filter("doc_id = 7").select("ids")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan and "n_tokens" not in plan
    assert one.first().ids == [*BYTE("word"), 2]
    orc_tokens.write(docs(spark, []), path + "-empty", parts=2)
    assert orc_tokens.digests(spark, path + "-empty").count() == 0
