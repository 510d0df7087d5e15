"""WARC archives of pages and their merged capture index.

``write_archives`` gives every page a WARC record: a response with the page as payload, or a revisit where a
record with the same payload is the response. Records are written in files sorted by URL key and time. ``read_runs``
reads the files back, record by record, and gives one sorted run of captures per file. ``merged_index`` deals the runs out by
ranges of (URL key, time) and merges the k runs of each range with a loser tree, so that the parts in order are the
capture history of every URL.

Edge cases: a null page is an empty payload; a null URL has an empty key and no target line; a null id is written
as such and comes back as null; ids may repeat, of equal rows one is the response; an empty table gives no records;
other columns are not read. A file holds ``RECORDS`` records at most, and one record is in memory at a time.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.registry import query
from pagemill.session import shared_folder, table, written

#: Payloads of fewer bytes are never revisits; records of a file at most.
LEAST_PAYLOAD, RECORDS = 1000, 5000
#: Time of capture of page 0; page n is taken n seconds later.
FIRST_CAPTURE = 1_700_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then the rest: com,example)/path."""
    url = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1)
    rest = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]*(.*)$", 1)
    return F.when(host == "", url).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least: int = LEAST_PAYLOAD) -> None:
    """Write one record per row of ``pages`` below ``folder``."""
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.regexp_replace(url_column, "[\\x00-\\x20\\x7f]", "%20").alias("url"), F.coalesce(html_column, F.lit("")).alias("html"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("bytes", F.octet_length("html"))
    rows = rows.withColumn("same", F.when(F.col("bytes") >= least, F.sha2(F.col("html").cast("binary"), 256)))
    top = F.max(F.struct(F.coalesce("id", F.lit(-(2**63))).alias("known"), "rid", "id"))
    copied = rows.filter("same IS NOT NULL").groupBy("same").agg(F.count(F.lit(1)).alias("n"), top.alias("top")).filter("n > 1").select("same", "top")
    rows = rows.join(copied, "same", "left").withColumn("revisit", F.col("top").isNotNull() & (F.col("top.rid") != F.col("rid")))

    taken = F.timestamp_seconds(F.pmod(F.coalesce("id", F.lit(0)), F.lit(10**9)) + FIRST_CAPTURE)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    urn = lambda value: F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html")))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.date_format("taken", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        F.coalesce(line("X-URL-Key", F.col("key")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("html").cast("binary")))),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(F.col("top.id"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )
    rows = rows.withColumn("taken", taken).withColumn("key", url_key(F.col("url"))).sortWithinPartitions("key", "taken", "id")
    rows.select(record.alias("value")).write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder)


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record of one gzipped file."""
    stream = io.BufferedReader(_Inflated(content), 1 << 16)
    at = 0
    while True:
        first = stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        size, fields = len(first), {}
        while (text := stream.readline()) not in (b"\r\n", b""):
            size += len(text)
            name, _, value = text.decode().partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut short")
        yield at, fields, block
        at += size + 2 + length + 4


class _Inflated(io.RawIOBase):
    """The bytes of a gzip file, inflated as they are read."""

    def __init__(self, content: bytes):
        self.content, self.at, self.inflate = memoryview(content), 0, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self.inflate.unconsumed_tail:
                data = self.inflate.decompress(self.inflate.unconsumed_tail, len(buffer))
            elif self.inflate.eof:
                rest = self.inflate.unused_data or bytes(self.content[self.at : self.at + (1 << 18)])
                self.at += 0 if self.inflate.unused_data else 1 << 18
                if not rest:
                    return 0
                self.inflate = zlib.decompressobj(31)
                data = self.inflate.decompress(rest, len(buffer))
            elif self.at < len(self.content):
                data = self.inflate.decompress(bytes(self.content[self.at : self.at + (1 << 18)]), len(buffer))
                self.at += 1 << 18
            else:
                return 0
            if data:
                buffer[: len(data)] = data
                return len(data)


CAPTURE = "run string, url_key string, captured_at string, offset long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(value: str) -> int | None:
    number = value.rpartition(":")[2].rstrip(">")
    return None if number == "null" else int(number)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives; those of one file are a run, sorted by URL key and time. Digests are taken from the payloads."""

    def parse(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                run, rows = path.as_py().rpartition("/")[2], []
                for at, fields, block in records(content.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(head.rpartition(b"Content-Length:")[2])
                    if kind == "response" and (size != len(payload) or digest != hashlib.sha1(payload).hexdigest()):
                        raise ValueError(f"{run}: the payload at {at} is damaged")
                    refers = _urn(fields["warc-refers-to"]) if kind == "revisit" else None
                    rows.append((run, fields.get("x-url-key", ""), fields["warc-date"], at, _urn(fields["warc-record-id"]), size, digest, kind, refers))
                if rows:
                    names = [x.split(" ")[0] for x in CAPTURE.split(", ")]
                    kinds = {"long": pa.int64(), "string": pa.string()}
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split(" ")[1]]) for c, x in zip(zip(*rows), CAPTURE.split(", "))], names)

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(parse, CAPTURE)


class LoserTree:
    """Merges k sorted sequences: each inner node keeps the loser of the match played there, the winner moves up."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [self._head(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _head(self, i: int):
        run, at = self.runs[i], self.at[i]
        return (0, self.key(run[at]), i) if at < len(run) else (1, (), i)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # the first to come waits for its match
                self.losers[node] = i
                return
            if self.heads[other] < self.heads[i]:
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while self.k:
            winner = self.losers[0]
            if self.heads[winner][0]:
                return
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            self.heads[winner] = self._head(winner)
            self._play(winner)


def merged_index(runs: DataFrame) -> DataFrame:
    """The captures of all runs by (url_key, captured_at, page_id): each part is a range, parts follow one another."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = runs.columns
    at = [names.index(n) for n in ("url_key", "captured_at", "page_id", "run", "offset")]
    order = lambda row: (row[at[0]], row[at[1]], row[at[2]] is not None, row[at[2]] or 0, row[at[3]], row[at[4]])
    schema = ", ".join(f"{n} {t}" for n, t in runs.dtypes)

    def merge(batches):
        segments: dict[str, list] = {}
        kinds = None
        for batch in batches:
            kinds = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                segments.setdefault(row[at[3]], []).append(row)
        for run in segments.values():
            run.sort(key=order)  # sorted already but where a file was read in parts
        out = []
        for row in LoserTree(list(segments.values()), order):
            out.append(row)
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], names)

    return runs.repartitionByRange(parts, "url_key", "captured_at", "page_id").mapInArrow(merge, schema)


def capture_history(pages: DataFrame) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back as one capture index."""
    folder = f"{shared_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return merged_index(written(read_runs(pages.sparkSession, folder)))


@query(
    f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
    g AS (SELECT h, max(page_id) AS top FROM p WHERE octet_length(encode(h)) >= {LEAST_PAYLOAD} GROUP BY h)
    SELECT page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest,
      CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to
    FROM p LEFT JOIN g ON p.h = g.h
    """
)
def op5_warc_index(spark, folder):
    """Every page as a WARC record, read back through the merged index of all archives."""
    return capture_history(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
