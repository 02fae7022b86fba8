"""The join against a comparison of everything with everything."""

import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import docs, prose, rows
from tests.llm.test_dedup import brute
from zonepulse.llm import ngram_join


def found(frame):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(frame).collect())


def edited(n, seed, most):
    """Chains of edits around the limit, copies of copies, and texts that only share a passage."""
    rnd, base, out = random.Random(seed), [prose(120, 50 + k) for k in range(6)], []
    passage = prose(60, 99)
    for k in range(n):
        words = base[k % 6].split()
        for _ in range(rnd.randint(0, most)):
            words[rnd.randrange(len(words))] = f"new{rnd.randint(0, 9)}"
        base.append(" ".join(words))
        out.append((1000 + k, base[rnd.randrange(len(base))] if k % 3 else " ".join(words)))
        if k % 5 == 0:
            out.append((5000 + k, passage + " " + prose(90, 700 + k)))
    return out


@pytest.mark.parametrize("seed, cell, block, many", [(2, 1024, 10**6, 8), (3, 4, 3000, 2), (4, 3, 100, 1)])
def test_against_brute_force(spark, monkeypatch, seed, cell, block, many):
    monkeypatch.setattr(ngram_join, "_CELL", cell)
    monkeypatch.setattr(ngram_join, "_BLOCK", block)
    monkeypatch.setattr(ngram_join, "_MANY", many)
    monkeypatch.setattr(ngram_join, "_BUCKET", 2000)
    some = [(i, t) for i, t, *_ in rows() if i != 16] + edited(150, seed, 6)
    frame = docs(spark, [(i, t, "en", "s", 0, "", "", "", "") for i, t in some])
    assert found(frame.repartition(5)) == brute(some, 80)


def test_nothing(spark):
    assert ngram_join.join(docs(spark, [])).count() == 0
    blank = docs(spark, [(k, t, *[None] * 7) for k, t in ((1, None), (2, " "), (3, ""), (None, None))])
    assert found(blank) == collections.Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None)])


def test_group_that_stays_apart(spark, monkeypatch):
    """Many texts share their rare n-grams, and no two are alike."""
    monkeypatch.setattr(ngram_join, "_CELL", 50)
    passage = prose(40, 5)
    some = [(k, passage + " " + prose(30, 100 + k // 2) + f" end{k % 2}") for k in range(400)]
    frame = docs(spark, [(i, t, *[None] * 7) for i, t in some])
    assert found(frame) == brute(some, 80)


def test_very_long_text(spark):
    long = prose(150_000, 3)
    some = [(1, long), (2, long + " more"), (3, prose(50, 4))]
    assert found(docs(spark, [(i, t, *[None] * 7) for i, t in some])) == brute(some, 80)


def bucket(blocks, sets, n, top, seed):
    """The rows of one bucket of several blocks, and in how many sets each value lies."""
    rng, rows, seen = np.random.default_rng(seed), [], collections.Counter()
    for b in range(blocks):
        made = [np.unique(rng.integers(0, top, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(sets)]
        if top < 10**6:
            seen.update(int(x) >> 32 for s in made for x in s)
        rows += [{"block": str(b), **p} for p in ngram_join._pack(made, 0)[0]]
    kinds = [("block", pa.string()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("values", "owners", "counts")]]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds)), seen


@pytest.mark.parametrize("step", [1, 40, 10**6])
def test_bucket_is_counted_range_by_range(monkeypatch, step):
    table, seen = bucket(4, 30, 40, 500, step)
    monkeypatch.setattr(ngram_join, "_RANGE", step)
    told = ngram_join._shared(table).to_pylist()
    for row, made in zip(table.to_pylist(), told, strict=True):
        values, owners = np.frombuffer(row["values"], np.uint32), np.frombuffer(row["owners"], np.uint16)
        expected = [(v, o, seen[v]) for v, o in zip(values.tolist(), owners.tolist()) if seen[v] > 1]
        assert list(zip(*[np.frombuffer(made[c], k).tolist() for c, k in (("values", np.uint32), ("owners", np.uint16), ("found", np.uint32))])) == expected


def test_bucket_takes_little_memory():
    table, _ = bucket(10, 10, 20_000, 1 << 62, 1)
    tracemalloc.start()
    ngram_join._shared(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50e6  # two million entries; sorted at once, they took more than 90 MB


def test_rows_of_blocks_are_small(spark):
    texts = [(i, prose(20_000, i)) for i in range(8)] + [(8, None), (9, "one two")]
    made = ngram_join.blocks(docs(spark, [(i, t, *[None] * 7) for i, t in texts]).coalesce(1), 7)
    rows = made.collect()
    heads, packs = [r for r in rows if r.bucket is None], [r for r in rows if r.bucket is not None]
    assert len(heads) == 1 and sorted(heads[0].doc_id) == list(range(10)) and len({r.bucket for r in packs}) == len(packs) > 100
    assert all(r.values is None for r in heads) and all(r.doc_id is None and r.block == heads[0].block for r in packs)
    assert sum(len(r.values) // 4 for r in packs) > 100_000 and max(len(r.values) + len(r.owners) for r in packs) < 20_000


def test_packing_a_block_takes_little_memory():
    sets = [np.unique(np.random.default_rng(i).integers(0, 1 << 62, 20_000).astype(np.uint64) * np.uint64(2654435769)) for i in range(50)]
    tracemalloc.start()
    packs = ngram_join._pack(sets, 5)[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(packs) == 32 and most < 50e6  # a million entries; with an order beside the keys they took 54 MB
