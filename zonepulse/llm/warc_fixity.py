"""WARC files and their fixity: hash trees over records and offset ranges, compared between replicas.

A replica's records are hashed with their place: file, number in the file, offset and length. Runs of ``FAN`` records
that follow each other make a node, whose hash is that of its children's hashes and offset range; runs of
nodes make the next level, files are joined the same way, and one root stands for the replica. Two replicas
with one root are equal. Otherwise only the children of nodes that differ are looked at, level by level, down
to the records.

A file may be one gzip member or many (usually one for each record); whatever stands in it that is not a whole
member is a leaf of its own, so no byte of a file goes unseen.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.sources.scratch import materialize

FAN = 16
#: Line end of headers, and what follows a record; fixed by the format.
CRLF = "\r\n"
END = CRLF + CRLF
_PART = re.compile(r"(.*/)?part-(\d+)-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?:-c(\d+))?[^/]*")
_STEP = 1 << 16  # bytes given to a gzip member at once, which bounds what is copied behind its end
_LEAF = "file int, number bigint, offset bigint, length bigint, record_id string, hash string"


def _flat(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def records(pages: DataFrame) -> DataFrame:
    """(page_id, url, record): each page as a WARC response record. A null page is an empty one; a null url has no header line."""
    body = F.coalesce("html", F.lit(""))
    lines = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.lit("WARC-Type: response"), F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), _flat(F.col("url"))), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.concat(lines, F.lit(END), body).alias("record"))


def write(pages: DataFrame, path: str, files: int | None = None) -> None:
    """Writes the pages as gzip WARC files, in the order of page_id within a file (nulls first).

    Without ``files`` each task writes what it scans, so nothing is shuffled and replicas of one table have one
    layout. With ``files`` records are dealt over so many files by a hash of page_id and url.
    """
    rows = records(pages)
    if files is not None:
        rows = rows.repartition(files, "page_id", "url")
    rows = rows.sortWithinPartitions("page_id", "url", F.octet_length("record"), F.xxhash64("record"))
    rows.select("record").write.option("lineSep", END).option("compression", "gzip").text(path)


def _parsed(data: bytes) -> Iterator[tuple[int, int, str | None, bytes]]:
    """(offset, length, record id, bytes) of the records of a file; what cannot be parsed is one last record."""
    at, end = 0, END.encode()
    while at < len(data):
        head = data.find(end, at)
        fields = {}
        for line in data[at : max(head, at)].split(CRLF.encode())[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        size = fields.get(b"content-length", b"")
        stop = head + len(end) + int(size) if head >= 0 and size.isdigit() else len(data)
        if not data.startswith(b"WARC/", at) or stop > len(data):
            yield at, len(data) - at, None, data[at:]
            return
        yield at, stop - at, fields.get(b"warc-record-id", b"").decode("utf-8", "replace").strip("<>") or None, data[at:stop]
        at = stop + len(end) if data.startswith(end, stop) else stop


def _unpacked(content: pa.Buffer | bytes) -> tuple[bytes, bytes]:
    """The bytes of all gzip members of a file, and what else there is: a mark with the file's own bytes, or nothing.

    What is not gzip, or is damaged, counts as it stands from that member on. A member without its end gives what it can and is
    marked as well, and so are members without content behind the first.
    """
    raw, out, at, hollow = memoryview(content), io.BytesIO(), 0, 0
    while at < len(raw):
        start, before, member = at, out.tell(), zlib.decompressobj(31)
        try:
            while at < len(raw) and not member.eof:
                out.write(member.decompress(raw[at : at + _STEP]))
                at = min(at + _STEP, len(raw))
        except zlib.error:
            out.seek(before)
            out.truncate()
            return out.getvalue(), b"\0" + raw[start:]
        at -= len(member.unused_data)
        if not member.eof:
            return out.getvalue(), b"\1" + raw[start:]
        hollow += start > 0 and out.tell() == before
    return out.getvalue(), b"\2%d" % hollow if hollow else b""


def _names(spark: SparkSession, path: str) -> dict[str, str]:
    """The files under ``path`` and a name for each that its counterpart in another replica has too.

    It is the path below ``path``; names that Spark gave are without what differs from write to write. Of files that would
    share a name all but the first get a number.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString() + "/"
    found: dict[str, str] = {}
    taken: set[str] = set()
    for full in sorted(r[0] for r in _files(spark, path).select("path").collect()):
        name = full[len(top) :] if full.startswith(top) else full.rpartition("/")[2]
        if part := _PART.fullmatch(name):
            name = f"{part[1] or ''}part-{int(part[2]):010}-c{int(part[3] or 0):03}"
        again, base = 1, name
        while name in taken:
            again += 1
            name = f"{base}#{again}"
        taken.add(name)
        found[full] = name
    return found


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def _places(names: set[str]) -> dict[str, int]:
    """A number for every name: that of its part where all are plain part files, else its place in their order."""
    plain = {n: int(n[5:15]) for n in names if re.fullmatch(r"part-\d{10}-c000", n)}
    return plain if len(plain) == len(names) else {n: i for i, n in enumerate(sorted(names))}


def leaves(spark: SparkSession, path: str, places: dict[str, int] | None = None) -> DataFrame:
    """(file, number, offset, length, record_id, hash) of every record under ``path``; one file is held at a time.

    Bytes behind the records, and a missing end, are one more row without a record id. ``places`` tells the
    number of every file, so that two replicas number theirs alike. Files of no bytes count as absent.
    """
    if places is None:
        names = _names(spark, path)
        numbers = _places(set(names.values()))
        places = {full: numbers[name] for full, name in names.items()}
    shared = spark.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                file = shared.value[name]
                data, rest = _unpacked(content.as_buffer())
                rows = [(file, i, at, n, who, hashlib.sha256(raw).hexdigest()) for i, (at, n, who, raw) in enumerate(_parsed(data))]
                if rest:
                    rows.append((file, len(rows), len(data), len(rest) - 1, None, hashlib.sha256(rest).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _LEAF.split(", ")])

    return _files(spark, path).select("path", "content").mapInArrow(run, _LEAF)


def _above(nodes: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The level over ``nodes``: one row for every ``FAN`` places, with their joint hash and range."""
    up = F.expr(f"{place} DIV {FAN}")
    children = F.sort_array(F.collect_list(F.struct(place, "offset", "length", "hash")))  # at most FAN
    text = F.concat_ws("|", F.transform("c", lambda x: F.concat_ws(" ", x[place], x["offset"], x["length"], x["hash"])))
    made = nodes.groupBy(*keys, up.cast("bigint").alias(f"{place}_")).agg(children.alias("c"))
    return made.select(*keys, F.col(f"{place}_").alias(place), F.col("c")[0]["offset"].alias("offset"), F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x["length"]).alias("length"), F.sha2(text, 256).alias("hash"))


def tree(found: DataFrame) -> list[DataFrame]:
    """Levels over a replica's records, from the records up to one node a file.

    Each level is written, so the next and the comparison read rows and do not hash again; a level has a sixteenth of
    the rows of the one below.
    """
    inner = [found.select("file", "number", "offset", "length", "hash")]
    most = inner[0].agg(F.max("number")).first()[0] or 0
    while most > 0:
        inner.append(materialize(_above(inner[-1], ["file"], "number"), "merkle"))
        most //= FAN
    return inner


def over_files(top: DataFrame) -> list[DataFrame]:
    """Levels over the files of a replica, from one row a file up to the root."""
    outer = [top.select(F.col("file").cast("bigint").alias("file"), F.lit(0).cast("bigint").alias("offset"), "length", "hash")]
    most = outer[0].agg(F.max("file")).first()[0] or 0
    while most > 0:
        outer.append(materialize(_above(outer[-1], [], "file"), "merkle"))
        most //= FAN
    return outer


def _unlike(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hash differs, or that only one side has."""
    left, right = a.select(*keys, F.col("hash").alias("hash_a")), b.select(*keys, F.col("hash").alias("hash_b"))
    return left.join(right, keys, "full").filter(~F.col("hash_a").eqNullSafe(F.col("hash_b"))).select(*keys)


def _below(level: DataFrame, unlike: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The nodes of a level whose parent is unlike."""
    parent = unlike.withColumnRenamed(place, "parent")
    return level.withColumn("parent", F.expr(f"{place} DIV {FAN}")).join(parent, [*keys, "parent"], "left_semi").drop("parent")


def _padded(levels: list[DataFrame], height: int, keys: list[str], place: str) -> list[DataFrame]:
    """As many levels as the other replica has; a higher level over one node is hashed the same way."""
    out = list(levels)
    while len(out) < height:
        out.append(_above(out[-1], keys, place))
    return out


def compare(spark: SparkSession, replica_a: str, replica_b: str) -> DataFrame:
    """Records that differ: file, number, status, record_id, offset, length and hash of either side.

    ``status``: ``changed``, ``missing`` (only in the first) or ``extra`` (only in the second). Equal replicas, two
    empty ones too, give no rows. A record that was lost within a file moves those behind it, which then differ.
    """
    names = [_names(spark, replica) for replica in (replica_a, replica_b)]
    numbers = _places({n for found in names for n in found.values()})
    a, b = (materialize(leaves(spark, replica, {full: numbers[n] for full, n in found.items()}), "leaves") for replica, found in zip((replica_a, replica_b), names, strict=True))
    in_a, in_b = tree(a), tree(b)
    high = max(len(in_a), len(in_b))
    in_a, in_b = _padded(in_a, high, ["file"], "number"), _padded(in_b, high, ["file"], "number")
    out_a, out_b = over_files(in_a[-1]), over_files(in_b[-1])
    wide = max(len(out_a), len(out_b))
    out_a, out_b = _padded(out_a, wide, [], "file"), _padded(out_b, wide, [], "file")
    unlike = _unlike(out_a[-1], out_b[-1], ["file"])  # the roots
    for level_a, level_b in zip(reversed(out_a[:-1]), reversed(out_b[:-1]), strict=True):
        unlike = _unlike(_below(level_a, unlike, [], "file"), _below(level_b, unlike, [], "file"), ["file"])
    files = unlike.select(F.col("file").cast("int").alias("file"))
    unlike = _unlike(in_a[-1].join(files, "file", "left_semi"), in_b[-1].join(files, "file", "left_semi"), ["file", "number"])
    for level_a, level_b in zip(reversed(in_a[:-1]), reversed(in_b[:-1]), strict=True):
        unlike = _unlike(_below(level_a, unlike, ["file"], "number"), _below(level_b, unlike, ["file"], "number"), ["file", "number"])
    unlike = materialize(unlike, "unlike")
    side = lambda df, s: df.join(unlike, ["file", "number"], "left_semi").select("file", "number", *[F.col(c).alias(f"{c}_{s}") for c in ("record_id", "offset", "length", "hash")])
    both = side(a, "a").join(side(b, "b"), ["file", "number"], "full")
    status = F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").otherwise("changed")
    return both.select(
        "file", "number", status.alias("status"), F.coalesce("record_id_a", "record_id_b").alias("record_id"),
        F.coalesce("offset_a", "offset_b").alias("offset"), "length_a", "length_b", "hash_a", "hash_b",
    )


def damaged(pages: DataFrame) -> DataFrame:
    """The pages as a failing disk might give them back: every 97th id has another first character, or a first one."""
    hit = F.coalesce(F.pmod(F.col("page_id"), F.lit(97)) == 13, F.lit(False))
    body = F.coalesce("html", F.lit(""))
    first = F.when(F.substring(body, 1, 1) == "#", "@").otherwise("#")
    return pages.withColumn("html", F.when(hit, F.concat(first, F.substring(body, F.lit(2), F.length(body)))).otherwise(F.col("html")))


def oracle_sql() -> str:
    """The records that differ between the pages and their damaged copy, in DuckDB SQL."""
    def record(body: str) -> str:
        lines = ["'WARC/1.1'", "'WARC-Type: response'", "'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'none') || '>'",
                 "'WARC-Target-URI: ' || regexp_replace(url, '[\\r\\n]+', ' ', 'g')", f"'Content-Length: ' || strlen({body})"]
        end = "chr(13) || chr(10)"
        return f"concat_ws({end}, {', '.join(lines)}) || {end} || {end} || {body}"

    return f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS a, (CASE WHEN html[1] = '#' THEN '@' ELSE '#' END) || coalesce(html, '')[2:] AS b
               FROM pages WHERE page_id % 97 = 13)
    SELECT 'urn:page:' || page_id AS record_id, 'changed' AS status, strlen({record('a')})::BIGINT AS length_a, strlen({record('b')})::BIGINT AS length_b,
           sha256({record('a')}) AS hash_a, sha256({record('b')}) AS hash_b FROM p"""
