"""WARC archives: written by the text sink, read back by verifying the chain of record boundaries.

Writing puts one record on each row; the sink's line separator is the two line ends that close
a record. Copies of a payload become revisit records of the one with the largest id.

Reading cuts archives of any size wherever the engine splits them. Each task walks the lines of
its block, cuts its bytes into pieces at every line that looks like the start of a record, and
emits for each such candidate its offset and that of its successor (from its header). Offsets
count from the block's first line; the blocks' byte sums make them absolute. Pointer jumping
from the start of each file then marks the candidates that the chain of successors reaches, so
that record starts inside payloads are given up, and pieces go to the last reached record
before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.frames import saved, table
from millrace.session import fresh_folder

END = "\r\n\r\n"
#: Payloads from this size on are written once; smaller copies are all written.
LEAST_REVISIT = 0
#: A piece is sent on when it has so many bytes.
PIECE_BYTES = 4 << 20
#: Parts of the rows of one payload when they are joined with what is known of it.
SALT = 32
#: Rows of ids (at most 200 bytes each) that are sent to the tasks that hold the payloads; more
#: of them are joined by a shuffle of the payloads.
SENT_ROWS = 50_000

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_START = re.compile(rb"^WARC/\d+\.\d+\r$", re.M)
_FIELD = re.compile(rb"(?:WARC/\d+\.\d+|[!-9;-~]+:.*|[ \t].*)\r\n", re.S)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SCANNED = ("file string, block long, rel long, size long, data binary, starts boolean, header binary, open boolean, "
           "total long, lead binary, lead_done boolean")


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in base32, by built-in functions."""
    digest = F.sha1(payload)
    value = lambda i: F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
    return F.concat(*(F.substring(F.lit(_BASE32), F.shiftright(value(i), s).bitwiseAND(31) + 1, F.lit(1)) for i in range(8) for s in (15, 10, 5, 0)))


def _salted(hot: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with ``known``, a row for each key, whose rows are repeated for each salt."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    return (hot.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
            .join(known.withColumn("salt", salts), [*keys, "salt"], "left").drop("salt"))


def _few(rows: DataFrame) -> DataFrame:
    """Saved rows, marked for broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def archive_records(pages: DataFrame, least: int = LEAST_REVISIT, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One WARC record for each row of pages (page_id, url, html), as text without its closing line ends.

    Of rows whose payloads are equal and have at least ``least`` bytes, those with the largest
    page_id are responses, the others revisit it. A row with a null page_id is a response.
    Null html is the empty payload; a null url has no field, and control characters and white
    space in a url are written as percent codes.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"identity": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    ids = rows.where((F.col("size") >= least) & F.col("page_id").isNotNull()).select("page_id", "identity")
    several = ids.groupBy("identity").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first")).where("first < last").select("identity", "last")
    copies = saved(_salted(ids, several, ["identity"]).where("page_id < last").select(
        "page_id", "identity", F.col("last").alias("refers_to")).distinct(), "copies")
    rows = rows.join(_few(copies), ["page_id", "identity"], "left")
    url = F.expr(r"""array_join(transform(split(url, ''), c -> CASE WHEN c RLIKE '[\\x00-\\x20\\x7F]'
        THEN concat('%', lpad(hex(ascii(c)), 2, '0')) ELSE c END), '')""")
    revisit = F.col("refers_to").isNotNull()
    fields = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
              F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
              F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), url),
              F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("html").cast("binary"))),
              F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
              F.when(revisit, f"WARC-Profile: {_PROFILE}"), F.lit("Content-Type: text/html; charset=utf-8"),
              F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("size")).cast("string"))]
    return rows.select(F.concat(F.concat_ws("\r\n", *fields), F.lit(END), F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write_archives(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Writes records as archives, one file for each partition.

    A compressed archive is read by one task, as a stream; with ``none`` it is read in blocks.
    """
    records.write.option("lineSep", END).option("compression", compression).text(folder)


class _Block:
    """The pieces of one block, in order."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.out = file, block, []
        self.rel, self.data, self.held, self.starts = 0, [], 0, False
        self.read, self.lead, self.leading, self.lead_done = 0, [], True, False

    def add(self, raw: bytes) -> None:
        """Takes whole lines, the line ends included."""
        if self.leading:
            self.follow_lead(raw)
        at = 0
        for match in _START.finditer(raw):
            self.keep(raw[at:match.start()])
            self.send()
            self.starts, at = True, match.start()
        self.keep(raw[at:])
        if self.held >= PIECE_BYTES:
            data = b"".join(self.data)
            if not self.starts or self.header(data)[0] is not None or not self.header(data)[1]:
                self.send()
            else:
                self.data = [data]

    def keep(self, data: bytes) -> None:
        if data:
            self.data.append(data)
            self.held += len(data)

    def follow_lead(self, raw: bytes) -> None:
        """The first lines of the block as long as they could go on a header."""
        at = 0
        while self.leading and at < len(raw):
            end = raw.index(b"\n", at) + 1
            line = raw[at:end]
            if line == b"\r\n":
                self.leading, self.lead_done = False, True
            elif not _FIELD.fullmatch(line) or line.startswith(b"WARC/"):
                self.leading, self.lead = False, []
                return
            self.lead.append(line)
            at = end

    @staticmethod
    def header(data: bytes) -> tuple[bytes | None, bool]:
        """The header with its blank line if it is all there; whether it could go on after the data."""
        end = data.find(b"\r\n\r\n")
        if end >= 0:
            return data[:end + 4], False
        return None, all(_FIELD.fullmatch(line) for line in data.splitlines(True))

    def send(self) -> None:
        if self.held:
            data = b"".join(self.data)
            header, open_ = self.header(data) if self.starts else (None, False)
            self.out.append((self.file, self.block, self.rel, len(data), data, self.starts, header, open_, None, None, None))
            self.rel += self.held
        self.data, self.held, self.starts = [], 0, False

    def end(self) -> list[tuple]:
        self.send()
        lead = b"".join(self.lead) if self.lead_done or self.leading else None
        # Only the last piece of a block can have a header that goes on.
        self.out = [(*row[:7], row[7] and i == len(self.out) - 1, *row[8:]) for i, row in enumerate(self.out)]
        return [*self.out, (self.file, self.block, None, None, None, False, None, False, self.rel, lead, self.lead_done)]


_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.bool_()]
_NAMES = [f.split()[0] for f in SCANNED.split(",")]


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None
    for batch in batches:
        places = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
        lines = batch.column("line").to_pylist()
        start = 0
        while start < len(lines):
            stop = len(lines)
            if places[start] != places[-1]:
                stop = next(i for i in range(start, stop) if places[i] != places[start])
            if block is None or (block.file, block.block) != places[start]:
                if block:
                    yield _sent(block.end())
                block = _Block(*places[start])
            block.add(b"\n".join(lines[start:stop]) + b"\n")
            start = stop
        # All but the last piece, which may yet prove to be the one with an open header.
        if sum(row[3] for row in block.out[:-1]) >= PIECE_BYTES:
            yield _sent([(*row[:7], False, *row[8:]) for row in block.out[:-1]])
            block.out = block.out[-1:]
    if block:
        yield _sent(block.end())


def scanned(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all blocks, and a row of sums for each block (``total`` is set)."""
    lines = spark.read.option("lineSep", "\n").text(folder).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return lines.mapInArrow(_cut, SCANNED)


def candidates(scan: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, at, next, header, body) of all record starts: absolute offsets of the record, its
    successor and its payload. A header that goes on in the next block is completed from there."""
    starts = scan.where("starts").join(blocks.select("file", "block", "base", "place"), ["file", "block"]).select(
        "file", (F.col("base") + F.col("rel")).alias("at"), "place", "header", F.when(F.col("open"), F.col("data").cast("string")).alias("so_far"))
    known = starts.where("header IS NOT NULL").select("file", "at", F.col("header").cast("string").alias("header"))
    left = saved(starts.where("so_far IS NOT NULL").select("file", "at", "place", "so_far"), "open-headers")
    leads = blocks.where("lead IS NOT NULL").select("file", (F.col("place") - 1).alias("place"), F.col("lead").cast("string").alias("lead"), "lead_done")
    while not left.isEmpty():
        longer = saved(left.join(leads, ["file", "place"]).select("file", "at", F.col("place") + 1, F.concat("so_far", "lead"), "lead_done")
                       .toDF("file", "at", "place", "so_far", "done"), "open-headers")
        known = known.unionAll(longer.where("done").select("file", "at", "so_far"))
        left = longer.where("NOT done").drop("done")
    body = F.col("at") + F.octet_length("header")
    return known.withColumn("length", _length()).where("length IS NOT NULL").select(
        "file", "at", (body + F.col("length") + len(END)).alias("next"), "header", body.alias("body"))


def _length() -> Column:
    """The Content-Length of a header."""
    return F.nullif(F.regexp_extract("header", r"(?imd)^Content-Length:[ \t]*(\d{1,18})[ \t]*\r$", 1), F.lit("")).cast("long")


def reached(links: DataFrame) -> DataFrame:
    """(file, at) of the links (file, at, next) on the chain that starts at offset 0 of each file.

    Pointer jumping: each round marks what marked links point to and doubles every pointer, so
    the rounds are the logarithm of the longest chain. No file is followed by one task.
    """
    state = saved(links.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("mark")), "chain")
    while True:
        target = state.select("file", F.col("at").alias("to"), F.col("to").alias("further"), F.lit(True).alias("found"))
        both = state.join(target, ["file", "to"], "left")
        moved = both.select("file", "at", "further", "mark")
        marks = both.where("mark AND found").select("file", F.col("to").alias("at"), F.lit(None).cast("long").alias("further"), F.lit(True).alias("mark"))
        state = saved(moved.unionAll(marks).groupBy("file", "at").agg(F.max("further").alias("to"), F.max("mark").alias("mark")), "chain")
        if state.where("mark AND to IS NOT NULL").isEmpty():
            return state.where("mark").select("file", "at")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(file, at, header, payload_bytes, payload_digest, payload) for every record of the archives in ``folder``.

    ``at`` is the record's offset, ``header`` its text up to the blank line, ``payload`` its
    block of Content-Length bytes. Files may have any size; a record of any type is read.
    Record starts inside payloads are no records. Where a successor is no record start, the
    chain of that file ends; what follows is left out, as is a record cut off at the end. A
    record is one row, so its payload has to fit in a task; no folder of records gives no
    rows. Payloads are shuffled only if the caller uses them.
    """
    scan = saved(scanned(spark, folder), "pieces", "zstd")
    by_file = Window.partitionBy("file").orderBy("block")
    sums = scan.where("total IS NOT NULL").select("file", "block", "total", "lead", "lead_done")
    blocks = saved(sums.withColumns({
        "base": F.coalesce(F.sum("total").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "place": F.row_number().over(by_file)}), "blocks")
    links = saved(candidates(scan, blocks), "candidates")
    records = saved(links.join(reached(links), ["file", "at"]), "records")
    owned = saved(owners(scan, blocks, records), "owners")

    # Records that their first piece holds whole: everything is worked out beside the piece.
    first = (F.col("offset") == F.col("at")) & (F.col("offset") + F.col("size") >= F.col("next") - len(END))
    whole = owned.where(first).select("file", "block", "rel", "at")
    starts = scan.where("header IS NOT NULL").withColumn("header", F.col("header").cast("string")).withColumn("length", _length())
    payload = F.expr("substring(data, cast(octet_length(header) + 1 AS int), cast(length AS int))")
    alone = starts.where("length IS NOT NULL").select("file", "block", "rel", "header", *_measured(payload)).join(whole, ["file", "block", "rel"])

    # The others are put together from the pieces between their start and their successor.
    parts = saved(owned.join(whole.select("file", "at"), ["file", "at"], "left_anti").select("file", "block", "rel", "offset", "at"), "parts")
    pieces = scan.where("total IS NULL").select("file", "block", "rel", "data").join(_few(parts), ["file", "block", "rel"])
    grouped = pieces.groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("offset", "data"))).alias("parts"))
    data = F.expr("cast(array_join(transform(parts, p -> cast(p.data AS string)), '') AS binary)")
    joined = grouped.join(records, ["file", "at"]).withColumn("data", data).where(F.col("at") + F.octet_length("data") >= F.col("next") - len(END))
    cut = F.expr("substring(data, cast(body - at + 1 AS int), cast(next - 4 - body AS int))")
    columns = ["file", "at", "header", "payload_bytes", "payload_digest", "payload"]
    return alone.select(*columns).unionAll(joined.select("file", "at", "header", *_measured(cut)).select(*columns))


def _measured(payload: Column) -> list[Column]:
    return [F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"), payload.alias("payload")]


def owners(scan: DataFrame, blocks: DataFrame, records: DataFrame) -> DataFrame:
    """(file, block, rel, size, offset, at, next) of the pieces that lie in a record: the last one
    that starts before the piece. Only places are read here, no data."""
    index = scan.where("total IS NULL").select("file", "block", "rel", "size").join(blocks.select("file", "block", "base"), ["file", "block"]).select(
        "file", "block", "rel", "size", (F.col("base") + F.col("rel")).alias("offset"))
    starts = records.select("file", F.col("at").alias("offset"), F.col("at").alias("own"))
    index = index.join(starts, ["file", "offset"], "left")
    # Sorted by block; of the blocks before, one row each is looked at.
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = index.groupBy("file", "block").agg(F.max("own").alias("last")).withColumn("carried", F.last("last", True).over(by_file))
    in_block = Window.partitionBy("file", "block").orderBy("rel")
    placed = index.withColumn("at", F.last("own", True).over(in_block)).join(last.select("file", "block", "carried"), ["file", "block"]).withColumn(
        "at", F.coalesce("at", "carried"))
    return placed.join(records.select("file", "at", "next"), ["file", "at"]).where("offset < next").select(
        "file", "block", "rel", "size", "offset", "at", "next")


def field(name: str) -> Column:
    """A field of ``header``; null if it is not there."""
    return F.nullif(F.regexp_extract("header", rf"(?imd)^{name}:[ \t]*(.*?)[ \t]*\r$", 1), F.lit(""))


def _page(name: str) -> Column:
    return F.nullif(F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")


def described(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of read records.

    A revisit has the bytes and digest of the payload of the response it refers to; both are
    null if that is not among the records.
    """
    rows = saved(records.select(
        _page("WARC-Record-ID").alias("page_id"), "payload_bytes", "payload_digest", field("WARC-Type").alias("record_type"), _page("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("named")), "described")
    revisits = rows.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "named")
    wanted = revisits.select("refers_to", "named").distinct()
    known = rows.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named"), "payload_bytes", "payload_digest").distinct()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("record_type <> 'revisit'").select(*columns).unionAll(
        _salted(revisits, known.join(wanted, ["refers_to", "named"], "left_semi"), ["refers_to", "named"]).select(*columns))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back: payload digests, and what revisits what.

    Rows that repeat a page_id are written each; equal rows of the largest page_id are all
    responses. Other columns are not looked at. An empty table gives no rows.
    """
    folder = fresh_folder(spark, "archives")
    write_archives(archive_records(table(spark, sf_dir, "pages")), folder)
    return described(read_archives(spark, folder))


OP12_SQL = r"""
WITH base AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last, sha1(html) AS digest FROM base)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(flatten(list_transform(range(0, 8), lambda i: list_transform([32768, 1024, 32, 1], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, 5 * i + 1, 5))::INT // s) % 32 + 1)::INT, 1)))), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM marked
"""
