import glob
import gzip
import os

import numpy as np
import pytest

from zonepulse.llm import nearest, warc_fixity


def exact(ids, x, q, k):
    s = x @ x[q]
    order = [i for i in np.lexsort((ids, -np.round(s, 12))) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), s[i]) for i in order]


@pytest.mark.parametrize("scale", [1.0, 5.0])
def test_recall_and_scores(spark, scale, monkeypatch):
    monkeypatch.setattr(nearest, "_CELL", 100)  # several cells
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)) * rng.uniform(1, scale, (1500, 1))
    x[100:140] = x[100]  # a very common vector
    ids = np.arange(1500)
    frame = spark.createDataFrame([(int(i), [float(v) for v in r], "extra") for i, r in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>, score string")
    found = {}
    for r in nearest.search(frame, lambda c: c % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(range(0, 1500, 20))
    hits = 0
    for q, got in found.items():
        want, got = exact(ids, x, q, 20), sorted(got)
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(abs(x[q] @ x[i] - s) < 1e-9 for _, i, s in got)
        hits += len({i for i, _ in want} & {i for _, i, _ in got})
    assert hits / (20 * len(found)) >= 0.95
    twins = [i for _, i, _ in sorted(found[120]) if 100 <= i < 140]
    assert twins == [*range(100, 140)][: len(twins)] and (scale > 1 or len(twins) == 20)  # ties go to the smaller id


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (40, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {(r.query_id, r.rank, r.vec_id, r.score) for r in nearest.search(frame, lambda c: c % 20 == 0).collect()}
    assert found == {(0, 1, 1, 0.5), (0, 2, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 0, -1.0)}
    assert nearest.search(frame.filter("vec_id = 2"), lambda c: c % 20 == 0).count() == 0
    assert nearest.search(spark.createDataFrame([], "vec_id bigint, embedding array<double>"), lambda c: c % 20 == 0).count() == 0


def test_stopping_test():
    draws = np.random.default_rng(0).chisquare(nearest.DIMS, 200_000)
    assert abs(np.mean(draws <= nearest.stop_ratio()) - nearest.SURE) < 0.002


PAGES = [(i, f"http://x/{i}", "body %d \r\n\r\n text é " % i * (i % 5)) for i in range(400)] + [(None, None, None), (7, "http://x/7", "again"), (500, "a\r\nb", ""), (501, None, "z" * 300_000)]


def test_replicas(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    a, b, c = (str(tmp_path / n) for n in "abc")
    for path, some in ((a, pages), (b, pages), (c, warc_fixity.damaged(pages))):
        warc_fixity.write(some, path, 3)
    assert warc_fixity.compare(spark, a, b).count() == 0
    found = warc_fixity.compare(spark, a, c).collect()
    assert {(r.record_id, r.status) for r in found} == {(f"urn:page:{i}", "changed") for i in range(13, 400, 97)}
    data = {int(f.split("part-")[1][:5]): gzip.open(f).read() for f in glob.glob(f"{a}/part-*.gz")}
    for r in found:  # the place of the record is right
        assert data[r.file][r.offset :].startswith(b"WARC/1.1") and r.record_id.encode() in data[r.file][r.offset : r.offset + r.length_a]
    leaves = warc_fixity.leaves(spark, a)
    assert leaves.count() == len(PAGES) and leaves.filter("length > 300000").count() == 1


def test_lost_tail_and_unreadable_file(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    warc_fixity.write(pages, a, 2)
    warc_fixity.write(pages, b, 2)
    name = sorted(glob.glob(f"{b}/part-*.gz"))[0]
    data = gzip.open(name).read()
    for crc in glob.glob(f"{b}/.*.crc"):
        os.remove(crc)
    with gzip.open(name, "wb") as out:
        out.write(data[:2000])
    found = warc_fixity.compare(spark, a, b).collect()
    assert {r.file for r in found} == {0} and {r.status for r in found} == {"missing", "changed"}
    with open(name, "wb") as out:
        out.write(b"not a gzip file")
    found = warc_fixity.compare(spark, a, b).collect()
    n = warc_fixity.leaves(spark, a).filter("file = 0").count()
    assert len(found) == n
    empty = str(tmp_path / "e")
    warc_fixity.write(pages.limit(0), empty, 1)
    assert warc_fixity.compare(spark, empty, empty).count() == 0
    assert {r.status for r in warc_fixity.compare(spark, a, empty).collect()} == {"missing"}


def members(n: int, **other: str) -> list[bytes]:
    """Records of ``n`` pages as WARC files usually have them, each in a gzip member of its own."""
    made = []
    for i in range(n):
        body = other.get(f"p{i}", f"text of {i}").encode()
        made.append(gzip.compress(b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(body), body), mtime=0))
    return made


@pytest.mark.parametrize(
    ("change", "want"),
    [
        (lambda m: members(40, p31="other words"), {(31, "changed", "urn:page:31")}),  # behind the first member
        (lambda m: m[:-1], {(39, "missing", "urn:page:39")}),
        (lambda m: [*m, b"appended"], {(40, "extra", None)}),
        (lambda m: [*m, b"\0" * 512], {(40, "extra", None)}),
        (lambda m: [*m, gzip.compress(b"", mtime=0)], {(40, "extra", None)}),
        (lambda m: [*m[:-1], m[-1][:-5]], {(40, "extra", None)}),  # only the trailer is cut off
        (lambda m: [*m[:38], m[38][:-8] + b"\0" * 8, m[39]], {(38, "changed", "urn:page:38"), (39, "missing", "urn:page:39")}),  # a wrong checksum
    ],
)
def test_files_of_many_members(spark, tmp_path, change, want):
    a, b = tmp_path / "a", tmp_path / "b"
    for top, name, data in ((a, "CC-0001.warc.gz", members(40)), (b, "CC-0001.warc.gz", change(members(40))), (a, "more/x.warc.gz", members(3)), (b, "more/x.warc.gz", members(3))):
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(b"".join(data))
    assert warc_fixity.leaves(spark, str(a)).count() == 43
    assert {(r.number, r.status, r.record_id) for r in warc_fixity.compare(spark, str(a), str(b)).collect()} == want
    assert warc_fixity.compare(spark, str(b), str(b)).count() == 0


def test_files_of_any_name(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for top, names in ((a, ("one.warc.gz", "two.warc.gz", "x y%20.warc.gz")), (b, ("0.warc.gz", "one.warc.gz", "x y%20.warc.gz"))):
        top.mkdir()
        for name in names:
            (top / name).write_bytes(b"".join(members(2, p0=name)))
    found = warc_fixity.compare(spark, str(a), str(b)).collect()
    assert sorted((r.status, r.number) for r in found) == [("extra", 0), ("extra", 1), ("missing", 0), ("missing", 1)]


def test_each_length_is_searched_on_its_own(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=3 if i % 3 else 2)]) for i in range(60)]
    found = {}
    for r in nearest.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda c: c % 20 == 0, 5).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in (0, 20, 40):
        own = rows[q][1]
        want = sorted((-float(np.dot(own, v)), i) for i, v in rows if len(v) == len(own) and i != q)[:5]
        assert [i for _, i in sorted(found[q])] == [i for _, i in want]
