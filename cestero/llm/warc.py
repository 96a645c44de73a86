"""WARC records of pages, and a Merkle audit of what replicas hold.

A manifest lists the records of an archive in order, with ordinal, offset, length
and SHA-256. Over it stands a tree: a node covers ``FAN`` consecutive nodes and
hashes their offsets and digests, up to one root. Two replicas are intact if
their roots agree; otherwise the audit descends, a level at a time, only below
nodes that differ, and arrives at the records that do.

An archive is a folder of gzipped WARC files in order. Records are sorted by page
id and digest over the whole archive; ordinals and offsets come from counts per
partition, so no task sees more than its range. Records that are alike in all
are spread by their place in the input.

A null url or html is the empty one; a null id is written as an empty one and
sorts first. A replica with records missing or added differs from there on.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cestero.llm.text import staged

FAN = 16
#: Records of one file, at most.
RECORDS = 4096
END = "\r\n\r\n"
#: Compressed bytes that are read at a time.
_PIECE = 1 << 12
DATE = "2024-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column, date: Column) -> Column:
    """A response record without the blank lines that end it."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", ""),
        F.lit("\r\nWARC-Date: "),
        date,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
        body,
    )


def records(pages: DataFrame) -> DataFrame:
    """``page_id, record, sha256`` of each page."""
    text = record(F.col("page_id"), F.col("url"), F.col("html"), F.lit(DATE))
    return pages.select("page_id", text.alias("record")).withColumn(
        "sha256", F.sha2(F.col("record").cast("binary"), 256)
    )


def write_warc(rows: DataFrame, path: str) -> None:
    """``record`` of all rows as WARC files, in the order of ``page_id, sha256``."""
    place = F.monotonically_increasing_id()
    (
        rows.withColumn("place", place)
        .repartitionByRange("page_id", "sha256", "place")
        .sortWithinPartitions("page_id", "sha256", "place")
        .select("record")
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS)
        .text(path)
    )


def parsed(raw: bytes) -> Iterator[tuple[int, int]]:
    """Offset and length of each record; what cannot be parsed is one last record."""
    at, end = 0, END.encode()
    while at < len(raw):
        head = raw.find(end, at)
        length = None
        if head >= 0:
            length = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", raw[at:head])
        size = head + 4 + int(length[1]) - at if length else len(raw) - at
        size = min(size, len(raw) - at)
        yield at, size
        at += size + len(end)


def members(content: bytes) -> Iterator[bytes]:
    """What each gzip member of a file holds, or the file itself if it is not compressed.

    Of a damaged or cut member that is what comes before the damage; what follows
    it cannot be found and is left out, which an audit then tells.
    """
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content[:2] == b"\x1f\x8b":
        reader, parts, at = zlib.decompressobj(31), [], 0
        try:
            while at < len(content) and not reader.eof:
                parts.append(reader.decompress(content[at : at + _PIECE]))
                at += _PIECE
        except zlib.error:
            yield b"".join(parts)
            return
        yield b"".join(parts)
        content = reader.unused_data + content[at:] if reader.eof else b""


def records_of(content: bytes) -> Iterator[tuple[int, str]]:
    """Length and SHA-256 of a file's records, which members may divide anywhere between them."""
    for raw in members(content):
        for at, size in parsed(raw):
            yield size, hashlib.sha256(raw[at : at + size]).hexdigest()


def read_warc(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """``file, piece, name, number, length, sha256`` of the records below ``path``, in the order of
    the first four.

    Files that Spark wrote are in the order of their parts, others in that of their
    names. A damaged file has the records before the damage.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name = path.rpartition("/")[2]
                found = re.match(r"part-(\d+)\b.*?(?:-c(\d+))?\.", name)
                rows = list(records_of(content))
                if not rows:
                    continue
                yield pd.DataFrame(
                    {
                        "file": int(found[1]) if found else 0,
                        "piece": int(found[2] or 0) if found else 0,
                        "name": name,
                        "number": np.arange(len(rows)),
                        "length": [n for n, _ in rows],
                        "sha256": [h for _, h in rows],
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    schema = "file long, piece long, name string, number long, length long, sha256 string"
    return files.select("path", "content").mapInPandas(read, schema)


#: The order of the records that ``read_warc`` reads.
READ_ORDER = ("file", "piece", "name", "number")


def in_order(rows: DataFrame, *by: str) -> DataFrame:
    """``rows``, which have ``length``, with ``ordinal, offset`` in the order of ``by``.

    A record takes its length and the blank lines after it.
    """
    kept = rows.columns
    schema = rows.schema.add("part", "integer").add("ordinal", "long").add("offset", "long")
    size = len(END)

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, ordinal, offset = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            taken = batch["length"].to_numpy(np.int64) + size
            batch["part"] = part
            batch["ordinal"] = ordinal + np.arange(len(batch))
            batch["offset"] = offset + np.cumsum(taken) - taken
            ordinal, offset = ordinal + len(batch), offset + int(taken.sum())
            yield batch

    local = staged(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(numbered, schema)
    )
    # One row a partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = local.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("length") + size).alias("bytes")
    )
    parts = parts.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
    )
    return local.join(parts, "part").select(
        *kept,
        (F.col("ordinal") + F.col("n_before")).alias("ordinal"),
        (F.col("offset") + F.col("bytes_before")).alias("offset"),
    )


def manifest(rows: DataFrame) -> DataFrame:
    """``page_id, sha256, length, ordinal, offset`` of ``records``."""
    return in_order(
        rows.select(
            "page_id",
            "sha256",
            F.octet_length("record").cast("long").alias("length"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "page_id",
        "sha256",
        "place",
    ).drop("place")


def tree(listed: DataFrame, height: int) -> list[DataFrame]:
    """Levels ``node, start, sha256`` from the records up to the root, each written once."""
    level = listed.select(F.col("ordinal").alias("node"), F.col("offset").alias("start"), "sha256")
    levels = [level]
    child = F.struct("node", "start", "sha256")
    for _ in range(height):
        lines = F.transform(
            F.array_sort("children"),
            lambda c: F.concat_ws(":", c["start"].cast("string"), c["sha256"]),
        )
        level = staged(
            level.groupBy(F.floor(F.col("node") / FAN).alias("node"))
            .agg(F.min("start").alias("start"), F.collect_list(child).alias("children"))
            .select(
                "node", "start", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("sha256")
            )
        )
        levels.append(level)
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """``ordinal`` of the records in which two manifests differ.

    Two counts reach the driver; they tell how high the trees are.
    """
    most, height = max(first.count(), second.count()), 0
    while FAN**height < most:
        height += 1
    bad = None
    for a, b in zip(reversed(tree(first, height)), reversed(tree(second, height))):
        if bad is not None:
            above = bad.select(F.col("node").alias("parent"))
            below = F.floor(F.col("node") / FAN)
            a = a.join(above, below == F.col("parent"), "left_semi")
            b = b.join(above, below == F.col("parent"), "left_semi")
        other = b.select("node", F.col("start").alias("start_b"), F.col("sha256").alias("sha256_b"))
        bad = (
            a.join(other, "node", "full")
            .where(
                ~F.col("sha256").eqNullSafe(F.col("sha256_b"))
                | ~F.col("start").eqNullSafe(F.col("start_b"))
            )
            .select("node")
        )
    return bad.select(F.col("node").alias("ordinal"))
