"""The manifest against plain Python."""

import hashlib
import random
import zlib

import pytest

from tests.llm.data import docs, rows
from zonepulse.llm import merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"
    return h(*[field(x) for x in (row[0], row[3], row[2], row[4], text)])


def tree(leaves):
    """The root, and of every leaf the (left, right) texts on its way up."""
    level, ways, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            ways[i].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
        level = [h(*level[k : k + 8]) for k in range(0, len(level), 8)]
        at = [p // 8 for p in at]
    return level[0], ways


def brute(some):
    langs = {}
    for row in some:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for name in names:
        langs[name].sort(key=lambda x: x[:3])
        made[name] = tree([x[2] for x in langs[name]])
    root, top = tree([made[n][0] for n in names])
    out = []
    for name, above in zip(names, top):
        for (_, _, own, row), way in zip(langs[name], made[name][1]):
            way = way + above
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            f = leaf(row, text)
            for left, right in way:
                f = h(left, f, right)
            out.append((row[0], own, made[name][0], root, h(*[a + b for a, b in way]), f, f == root))
    return sorted(out, key=str)


def found(spark, some):
    got = merkle_manifest.proofs(merkle_manifest.manifest(docs(spark, some)))
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 9, 700])
def test_manifest(spark, n):
    rnd = random.Random(n)
    langs = [None, "", "en", "é", "zz", "en", "en"]
    some = [(i * 7 % (n + 1), f"Text {i} Ünd", rnd.choice(langs), rnd.choice(["a", None]), rnd.choice([None, i]), "", "", "", "") for i in range(n)]
    assert found(spark, some) == (brute(some) if some else [])


def test_awkward_rows(spark):
    some = rows()
    assert found(spark, some) == brute(some)
    one = [r for r in some if r[2] == "en"]
    assert found(spark, one) == brute(one)


def test_many_trees(spark):
    some = [(i, "Same", f"lang{i % 90:02d}", "s", 4, "", "", "", "") for i in range(300)]
    assert found(spark, some) == brute(some)
    several = merkle_manifest.manifest(docs(spark, some))
    assert {len(r.path) for r in several.collect()} == {4}
