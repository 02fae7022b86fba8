"""Token ids in ORC files: run-length coded integers, row indexes, Bloom filters on the document id.

Documents are dealt by ranges of their id and sorted, so part files follow the id order, the row indexes of
stripes and files prune by id, and Bloom filters skip the stripes of ids that are in range but absent. A file
is read by as many tasks as it has stripes.
"""

from __future__ import annotations

import zlib
from array import array
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepulse.llm.common import per_batch
from zonepulse.llm.tokens import library_encoder, vocabulary

#: Options of the writer: stripes that split well, an index entry every so many rows, Bloom filters on ids.
OPTIONS = {
    "compression": "zstd", "orc.stripe.size": str(16 << 20), "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
}
_STORED = "doc_id bigint, part int, place bigint, n_tokens bigint, ids array<int>"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, parts: int | None = None) -> None:
    """Writes (doc_id, part, place, n_tokens, ids) of all documents under ``path`` in ascending doc_id order.

    A null text counts as empty and gives the end id alone. Rows with a null doc_id come first; rows of one
    doc_id are ordered by a hash of their text, which also splits them over parts if there are many. An empty
    table gives a folder without rows.
    """
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        encoder, end = library_encoder(tokenizer), end_id.to_bytes(4, "little")
        part, place = TaskContext.get().partitionId(), count()

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x + end for x in encoder.encode_all(b["text"])]
            sizes = [len(x) // 4 for x in ids]
            ends = array("i", [0])
            for n in sizes:
                ends.append(ends[-1] + n)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            lists = pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)]), values)
            return pa.record_batch({"doc_id": b["doc_id"], "part": pa.array([part] * len(ids), pa.int32()), "place": pa.array([next(place) for _ in ids], pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "ids": lists})

        return step

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(per_batch(make), _STORED).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; filters on doc_id reach the row indexes and Bloom filters, other columns are not read."""
    return spark.read.schema(_STORED).orc(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from the files.

    ``start`` counts the ids of all documents before it: the totals of earlier parts (a few rows) plus a running
    sum within its part, in the order of the file. Parts are of even size, since they are ranges.
    """
    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = b["ids"]
        ends, data = lists.offsets.to_pylist(), memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(ends, ends[1:], strict=False)]
        return pa.record_batch({**{c: b[c] for c in ("doc_id", "part", "place", "n_tokens")}, "ids_crc32": pa.array(sums, pa.int64())})

    stored = read(spark, path)
    rows = stored.mapInArrow(per_batch(lambda: step), "doc_id bigint, part int, place bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return running.join(parts, F.col("part") == F.col("of")).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
