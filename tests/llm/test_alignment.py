"""Two tokenizers side by side against the libraries and a plain walk over byte offsets."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.data import docs, prose, rows
from zonepulse.llm import token_alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def visible():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


TABLE = visible()


def parts(text):
    a = [(i, bytes(TABLE[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def walk(text):
    """Groups as ([ids of A], [ids of B]), by stepping over the ends of both."""
    a, b = parts(text) if text else ([], [])
    ends = lambda side: {e for e in np.cumsum([len(x) for _, x in side]).tolist()}
    both, groups = sorted(ends(a) & ends(b)), []
    for side, k in ((a, 0), (b, 1)):
        at, g = 0, 0
        for i, x in side:
            at += len(x)
            if g == len(groups):
                groups.append(([], []))
            groups[g][k].append(i)
            g += at == both[g]
    return len(a), len(b), groups


def brute(some):
    walked = [(r[0], *walk(r[1])) for r in some]
    counts = collections.Counter((a[-1], b[-1]) for *_, groups in walked for a, b in groups)
    best = {}
    for (_, b), c in counts.items():
        best[b] = max(best.get(b, 0), c)
    out = []
    for doc_id, n_a, n_b, groups in walked:
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        links = [(a[-1], b[-1]) for a, b in groups]
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), shown))
    return out


def test_alignment(spark, monkeypatch):
    some = [*rows(), (30, "▁ low line"), (31, "<s> </s> <unk> <0x41> naïve ½ ﬁ"), (32, "日本語のテキスト"), (33, "x" * 5000 + " " + "ab " * 3000), (34, prose(300, 9).upper())]
    some = [(*r[:2], *[None] * 7) for r in some]
    frame = docs(spark, some).repartition(3)
    want = brute(some)
    got = token_alignment.corpus_links(token_alignment.align(frame))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[1] and w[3] < min(w[1], w[2]) for w in want)
    got = token_alignment.corpus_links(token_alignment.align(frame, digest=True))
    hashed = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(hashed, key=str)


def test_blocks_do_not_matter(spark):
    """The same rows in blocks of a few bytes."""
    aligner = token_alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), False)
    texts = [prose(40, k) for k in range(20)] + [None, ""]
    whole = aligner.block(list(range(22)), texts, "x")
    for k, text in enumerate(texts):
        one = aligner.block([k], [text], "y")
        assert [one[c][0] for c in ("n_a", "n_b", "n_groups", "groups")] == [whole[c][k] for c in ("n_a", "n_b", "n_groups", "groups")]


def test_nothing(spark):
    assert token_alignment.corpus_links(token_alignment.align(docs(spark, []))).count() == 0
    blank = docs(spark, [(1, None, *[None] * 7), (2, "", *[None] * 7)])
    assert sorted(map(tuple, token_alignment.corpus_links(token_alignment.align(blank)).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_long_chain():
    """One group of many tokens: the ends meet only at the last byte."""
    n = 100_000
    ends_a, ends_b = np.append(np.arange(2, 2 * n, 2), 2 * n + 1), np.append(np.arange(1, 2 * n, 2), 2 * n + 1)
    of_a, of_b = token_alignment.components(ends_a, ends_b)
    assert not of_a.any() and not of_b.any()
