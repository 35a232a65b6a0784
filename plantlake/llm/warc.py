"""WARC archives: written with Spark's text sink, read back in splits by verifying chains of record boundaries.

Writing. A payload of ``least`` bytes or more that occurs several times is stored once, in the response of the smallest id (ties: smallest
url), and its other rows are revisits without payload; shorter payloads are all responses. Which is which is decided on narrow rows (id, url,
digest, size), and only the payloads of responses are shuffled, once. A record ends with two line ends, which is the sink's line separator.

Reading. A split of a file yields what lies between occurrences of the magic, whether these begin a record or lie in a payload.

1. Every occurrence is a candidate. If a header with a content length follows, the candidate knows the offset of its successor.
2. In each split the candidates jump along their successors, doubling their reach each time, until the chain leaves the split.
3. The points where chains leave splits are few. Over these, pointer jumping from the start of each file finds those that are reachable:
   the number of rounds is the logarithm of the splits a file has.
4. Reachable entries mark their chain in their split. What is not marked was magic inside a payload and is rejected.
5. A record whose payload holds the magic was cut at it. Its pieces are read once more and joined in order.

The archive's payload digests and sizes are taken from the payloads that were read, except for revisits, whose headers hold them.

NULL payloads count as empty, NULL ids stay NULL and come last among equal payloads. Rows that agree in id, url and payload are records
of their own; one of them is the response. Empty tables give an archive without records. Payloads may hold the magic, whole records or
any bytes, and may be of any length below 2 GB. Control characters in urls are percent-encoded. Other columns, whatever their names,
don't matter. Files are read up to the point where the chain breaks; `broken_files` names files whose chain doesn't reach their end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlake.llm.common import stored
from plantlake.llm.ngram_join import grouped
from plantlake.session import scratch_path

#: The version line, the line ends, and the head of the stored responses.
MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are never revisits.
LEAST = 100
STEP = len(MAGIC)


# --- writing ----------------------------------------------------------------------------


def _uuid(text: Column) -> Column:
    d = F.md5(text)
    parts = [F.substring(d, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _printable(url: Column) -> Column:
    """A url as a header value; its end must not look like the magic before the line end that follows."""
    for raw, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        url = F.replace(url, F.lit(raw), F.lit(code))
    return F.regexp_replace(url, "WARC/1\\.1$", "%57ARC/1.1")


def _record(kind: str, record_id: Column, date: str, block_bytes: Column, refers: Column | None = None) -> Column:
    """The header of a record, up to the empty line."""

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    lines = [
        F.lit(f"{MAGIC}WARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
        line("WARC-Record-ID", record_id),
        line("WARC-Target-URI", _printable(F.col("url"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\n")),
        line("X-Row-Id", F.col("id")),
    ]
    if refers is not None:
        lines += [
            F.lit(f"WARC-Profile: {PROFILE}\r\n"),
            line("WARC-Refers-To", _uuid(F.concat(F.lit("response|"), F.col("digest")))),
            line("X-Refers-To-Row", refers),
            line("X-Payload-Bytes", F.col("bytes")),
        ]
    return F.concat(*lines, line("Content-Length", block_bytes), F.lit("\r\n"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write one record per row below ``path``.

    Compressed archives are read by one task each; their size is that of a shuffle partition. With ``none`` a file of any size is
    read in splits.
    """
    keys = ["digest", "id", "url"]
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload").cast("long")})
    copies = stored(rows.groupBy(*keys, "bytes").agg(F.count("*").alias("copies")), "warc-copies")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("url").isNull().alias("bare"), F.col("url").alias("url"))
    firsts = copies.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(place).alias("first"), F.sum("copies").alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    is_first = F.col("first").isNull() | (F.col("first.id").eqNullSafe(F.col("id")) & F.col("first.url").eqNullSafe(F.col("url")))
    responses = F.when(F.col("bytes") < least, F.col("copies")).when(is_first, 1).otherwise(0).cast("long")
    # One join form at every size: both sides grow with the input.
    told = copies.join(firsts.hint("merge"), "digest", "left").select(
        *keys, "bytes", "copies", F.col("first.id").alias("refers"), responses.alias("responses")
    )
    told = stored(told, "warc-told")

    kept = told.filter("responses > 0").select(*keys, "copies", "responses")
    met = rows.join(kept.hint("merge"), _same(rows, kept, keys)).select(*[rows[c] for c in rows.columns], "copies", "responses")
    whole = met.filter("copies = responses").select(*rows.columns)
    if not told.filter("responses = 1 and copies > 1").isEmpty():
        # Rows that agree in everything: one of them is the response, combined in each task before the next shuffle.
        once = met.filter("copies <> responses").groupBy(*keys, "bytes").agg(F.first("payload").alias("payload"))
        whole = whole.unionByName(once)
    # Short payloads may repeat in every respect; a running number keeps their record ids apart.
    named = F.when(F.col("bytes") >= least, F.concat(F.lit("response|"), F.col("digest"))).otherwise(
        F.concat_ws("|", F.lit("short"), "digest", "id", "url", F.monotonically_increasing_id())
    )
    head = _record("response", _uuid(named), date, F.col("bytes") + len(HTTP))
    records = whole.select(F.concat(head, F.lit(HTTP), "payload").alias("value"))
    again = told.filter("copies > responses").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies") - F.col("responses"))).alias("nth"))
    head = _record("revisit", _uuid(F.concat_ws("|", F.lit("revisit"), "digest", "id", "url", "nth")), date, F.lit(len(HTTP)), F.col("refers"))
    revisits = again.select(F.concat(head, F.lit(HTTP)).alias("value"))
    records.unionByName(revisits).write.option("lineSep", END).text(path, compression=compression)


# --- reading ----------------------------------------------------------------------------


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """What lies between occurrences of the magic, with its place: file, split, and order within the split."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC).text(path).select(
        meta.getField("file_path").alias("file"), meta.getField("file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"), "value"
    )


def _field(name: str) -> Column:
    """A header field of the text in ``head``; NULL if there is none."""
    return F.nullif(F.regexp_extract("head", f"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _parsed(lines: DataFrame) -> DataFrame:
    """Header fields, payload size and digest of the text in ``value`` as if a record began there."""
    head = F.substring_index("value", END, 1)
    lines = lines.withColumn("octets", F.octet_length("value").cast("long"))
    lines = lines.withColumn("head", F.when(F.octet_length(head) < F.col("octets"), head))
    lines = lines.withColumns(
        {
            "head_bytes": F.octet_length("head").cast("long"),
            "content": F.expr("try_cast(regexp_extract(head, '(?i)(?:^|\\r\\n)Content-Length:[ \\t]*([0-9]{1,18})[ \\t]*(?:\\r\\n|$)', 1) AS long)"),
        }
    )
    lines = lines.withColumn("fits", F.col("octets") >= F.col("head_bytes") + len(END) + F.col("content"))
    block = F.expr(f"substring(cast(value AS binary), cast(head_bytes + {len(END) + 1} AS int), cast(content AS int))")
    lines = lines.withColumn("block", F.when(F.col("fits"), block))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + len(END)
    skipped = F.when(F.lower(_field("Content-Type")).contains("msgtype=response"), F.least(http, F.octet_length("block"))).otherwise(0)
    lines = lines.withColumn("payload", F.substring(F.col("block"), skipped + 1, F.octet_length("block")))
    return lines.select(
        *[c for c in lines.columns if c in ("file", "split", "nth", "pos")],
        "octets",
        "head_bytes",
        "content",
        "fits",
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("X-Row-Id").alias("id"),
        _field("X-Refers-To-Row").alias("refers_to"),
        F.regexp_extract(F.coalesce(_field("WARC-Payload-Digest"), F.lit("")), "([0-9a-fA-F]*)$", 1).alias("said_digest"),
        _field("X-Payload-Bytes").cast("long").alias("said_bytes"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )


def _jumped(following: np.ndarray, times: int) -> np.ndarray:
    for _ in range(times):
        following = following[following]
    return following


def _local(octets: np.ndarray, split: int, head: pa.Array, content: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of the lines of a split: offset of the magic before each, offset of its successor (-1: none), index of that (its own if it is elsewhere)."""
    ends = np.cumsum(octets + STEP)
    start = ends - octets - STEP
    at, total = start - STEP, int(ends[-1])
    known = np.asarray(content.is_valid()) & np.asarray(head.is_valid())
    known[0] &= split > 0  # nothing precedes the first magic of a file
    size = np.asarray(head.fill_null(0)) + np.asarray(content.fill_null(0)) + 2 * len(END)
    after = np.where(known, start + size, -1)
    index = np.searchsorted(at, after)
    inside = known & (index < len(at)) & (at[np.minimum(index, len(at) - 1)] == after)
    following = np.where(inside, index, np.arange(len(at)))
    return at, after, following, total - STEP


_CHAINED = "ord int, at long, after long, exit long"


def _chained(names: list[str]):
    """Adds to the lines of each split where their chain leaves it; NULL if it breaks inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, 2):
            unit = unit.combine_chunks()
            octets = unit.column("octets").to_numpy()
            head, content = (unit.column(c).combine_chunks() for c in ("head_bytes", "content"))
            at, after, following, end = _local(octets, unit.column("split")[0].as_py(), head, content)
            last = _jumped(following, len(at).bit_length())
            leaves = after[last]
            columns = [
                pa.array(np.arange(len(at), dtype=np.int32)),
                pa.array(at),
                pa.array(after, mask=after < 0),
                pa.array(leaves, mask=leaves < end),
            ]
            whole = pa.Table.from_arrays([*unit.columns, *columns], names=[*names, "ord", "at", "after", "exit"])
            yield from whole.to_batches()

    return run


def _marked(names: list[str]):
    """Marks the lines that chains from the marked entries of their split pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, 2):
            unit = unit.combine_chunks()
            head, content = (unit.column(c).combine_chunks() for c in ("head_bytes", "content"))
            at, after, following, _ = _local(unit.column("octets").to_numpy(), unit.column("split")[0].as_py(), head, content)
            real = unit.column("real").to_numpy().copy()
            for _ in range(len(at).bit_length() + 1):
                real[following[real]] = True
                following = following[following]
            place = names.index("real")
            columns = [pa.array(real) if k == place else c for k, c in enumerate(unit.columns)]
            yield from pa.Table.from_arrays(columns, names=names).to_batches()

    return run


def _reachable(located: DataFrame, rounds: int) -> DataFrame:
    """file, pos: the entries that the chain from the start of each file passes, by pointer jumping over the points where chains leave splits."""
    reach = located.select("file").distinct().select("file", F.lit(0).cast("long").alias("pos"))
    if not rounds:
        return reach
    points = located.filter("exit is not null").select("file", F.col("exit").alias("pos")).unionByName(reach).distinct()
    hops = located.filter("exit is not null").select("file", "pos", "exit").join(points.hint("merge"), ["file", "pos"])
    hops = stored(hops, "warc-hops")
    reach = stored(reach, "warc-reach")
    for _ in range(rounds):
        further = reach.join(hops.hint("merge"), ["file", "pos"]).select("file", F.col("exit").alias("pos"))
        reach = stored(reach.unionByName(further).distinct(), "warc-reach")
        beyond = hops.select("file", F.col("pos").alias("exit"), F.col("exit").alias("far"))
        hops = stored(hops.join(beyond.hint("merge"), ["file", "exit"]).select("file", "pos", F.col("far").alias("exit")), "warc-hops")
    return reach


def _candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All candidates with their offsets and marks, and one row per file: file, size, splits."""
    lines = stored(_parsed(_lines(spark, path)), "warc-lines")
    by_split = lines.repartition("file", "split").sortWithinPartitions("file", "split", "nth")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema)
    chained = stored(by_split.mapInArrow(_chained(lines.columns), f"{fields}, {_CHAINED}"), "warc-chained")
    splits = chained.groupBy("file", "split").agg(F.sum(F.col("octets") + STEP).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split")
    base = F.sum("bytes").over(before) - F.col("bytes")
    splits = stored(splits.select("file", "split", base.alias("base"), "bytes"), "warc-splits")
    files = splits.groupBy("file").agg((F.max(F.col("base") + F.col("bytes")) - STEP).alias("size"), F.count("*").alias("splits"))
    most = files.agg(F.max("splits")).first()[0] or 1
    located = chained.join(splits.drop("bytes"), ["file", "split"]).select(
        *lines.columns, "ord", (F.col("base") + F.col("at")).alias("pos"), (F.col("base") + F.col("after")).alias("after"), (F.col("base") + F.col("exit")).alias("exit")
    )
    reach = _reachable(located, (most - 1).bit_length() + 1 if most > 1 else 0).select("file", "pos", F.lit(True).alias("real"))
    entered = located.join(reach.hint("merge"), ["file", "pos"], "left").withColumn("real", F.coalesce("real", F.lit(False)))
    entered = entered.select(*located.columns, "real").repartition("file", "split").select("file", "split", *[c for c in entered.columns if c not in ("file", "split")])
    entered = entered.sortWithinPartitions("file", "split", "nth")
    marked = entered.mapInArrow(_marked(entered.columns), entered.schema)
    return stored(marked, "warc-marked"), files


def _ordinals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, split, value → file, split, ord, value; the lines of a split follow each other in one task."""
    last, nth = None, 0
    for batch in batches:
        file, split = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ords = []
        for key in zip(file, split, strict=True):
            nth = nth + 1 if key == last else 0
            last = key
            ords.append(nth)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ords, pa.int32()), batch.column(2)], names=["file", "split", "ord", "value"])


def _rejoined(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    """The records that were cut at magic in their payload, parsed from their joined pieces."""
    cut = marked.filter("real and not fits").select("file").distinct()
    lines = marked.select("file", "split", "ord", "pos", "after", "real", "fits").join(cut, "file", "left_semi")
    along = Window.partitionBy("file").orderBy("pos")
    owner = F.last(F.when(F.col("real"), F.struct("pos", "after", "fits")), ignorenulls=True).over(along)
    needed = lines.withColumn("owner", owner).filter("not owner.fits and pos < owner.after")
    needed = needed.select("file", "split", "ord", "pos", F.col("owner.pos").alias("of"))
    raw = _lines(spark, path).select("file", "split", F.col("value").cast("binary").alias("value"))
    raw = raw.mapInArrow(_ordinals, "file string, split long, ord int, value binary")
    pieces = raw.join(needed, ["file", "split", "ord"]).groupBy("file", F.col("of").alias("pos"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    whole = pieces.agg(ordered.alias("parts")).select(
        "file", "pos", F.array_join(F.transform("parts", lambda p: p["value"].cast("string")), MAGIC).alias("value")
    )
    return _parsed(whole)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, pos, record_type, record_id, url, id, refers_to, payload_bytes, payload_digest, intact.

    Sizes and digests of revisits are those of the payload they refer to, as their header has it. ``intact`` tells whether a
    payload that was read has the digest its header names.
    """
    marked, _ = _candidates(spark, path)
    whole = marked.filter("real and fits")
    found = whole.select(*[c for c in whole.columns if c not in ("split", "nth", "ord", "after", "exit", "real")])
    if not marked.filter("real and not fits").isEmpty():
        found = found.unionByName(_rejoined(spark, path, marked).filter("fits").select(*found.columns))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "file",
        "pos",
        "record_type",
        "record_id",
        "url",
        "id",
        "refers_to",
        F.when(revisit, F.coalesce("said_bytes", "payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.lower("said_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        (revisit | (F.lower("said_digest") == F.col("payload_digest"))).alias("intact"),
    )


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """file, pos: files whose chain of records breaks, and the offset of the first record that isn't there."""
    marked, files = _candidates(spark, path)
    last = marked.filter("real").groupBy("file").agg(F.max("after").alias("pos"))
    whole = files.join(last, "file", "left").select("file", "size", F.coalesce("pos", F.lit(0).cast("long")).alias("pos"))
    return whole.filter("pos <> size").select("file", "pos")


def archived_pages(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    compression: str = "gzip",
) -> DataFrame:
    """Write the archives and read them back: id, payload_bytes, payload_digest, record_type and refers_to of each row."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, compression=compression)
    kind = pages.schema[id_col].dataType
    return read_archives(spark, path).select(
        F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
