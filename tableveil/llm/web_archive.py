"""WARC archives with de-duplicated payloads, and one globally ordered capture index over all of them.

Pages become WARC records: of records with equal payloads of at least `least` bytes the one with the largest page_id is
a response and the others revisit it. Records are sorted by URL key and time inside each output task, and the text
writer puts them down with the record end as its line separator, so every archive file is a locally sorted run of
captures. Reading streams a file's bytes back record by record, by content length. The runs' index entries are then
dealt out by ranges of (URL key, time, page) and each range merges its runs with a loser tree: the ranges in order are
one global order, and a URL with very many captures is cut by time.

Pages have no capture time of their own; it is taken as `START` plus page_id seconds.

Defined cases: null html is an empty payload; a null url gets an empty key; a null page_id is never revisited, revisits
an equal payload with an id, and counts as time 0; rows that repeat the largest page_id of their payload are responses
each; captures that tie in key, time and page stand in the order of their runs, then of their places; a payload may end
in any line ends; a very long payload is one record, whole in one task; an empty table gives archives without records
and an empty index; extra columns are left out.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, stored, table, whole

LEAST = 1000
START = 1_704_067_200  # 2024-01-01
RECORDS_PER_FILE = 4096
#: Index entries that one merge task holds.
MERGED = 100_000
END = "\r\n\r\n"
_PAGE = re.compile(rb"<urn:x-page:(-?\d*)>")

CAPTURE = "urlkey string, seconds long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, run string, place long, length long"


def url_key(url: Column) -> Column:
    """Host labels from the top level down, then path and query: com,example)/path?query."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#:]*)(?::\d+)?([^#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, parts, 1)), r"\.")), ",")
    return F.when(url == "", F.lit("")).otherwise(F.concat(host, F.lit(")"), F.regexp_extract(url, parts, 2)))


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, urlkey, seconds, payload, payload_bytes, payload_digest, record_type, refers_to."""
    page = F.col("page_id").cast("long")
    rows = pages.select(page.alias("page_id"), "url", whole("html").alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"), "urlkey": url_key(F.col("url")), "seconds": F.lit(START) + F.coalesce("page_id", F.lit(0))}
    )
    copies = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    # Payloads that stand once need no partner, so the other side has only repeated ones; Spark splits a hot one.
    rows = rows.join(copies.where("n > 1 and first is not null").drop("n"), "payload_digest", "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return rows.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first"))}).drop("first")


def _record(kind: Column) -> Column:
    """The record's text without the end that the writer adds."""
    name = lambda page: F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    response = kind == "response"
    block = F.when(response, F.concat(http, F.col("payload"))).otherwise(http)
    size = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name(F.col("page_id"))),
        ("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")),
        ("WARC-Date", F.date_format(F.timestamp_seconds("seconds"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(~response, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(~response, name(F.col("refers_to")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", size.cast("string")),
    ]
    # concat_ws leaves out the fields that are null.
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), *(F.concat(F.lit(f"{k}: "), v) for k, v in fields))
    return F.concat(lines, F.lit(END), block)


def write_archives(rows: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """rows as gzip WARC files; every file is sorted by URL key, time and page."""
    lines = rows.sortWithinPartitions("urlkey", "seconds", "page_id").select(_record(F.col("record_type")).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


class _Reader:
    """Cuts a file's bytes, which come in pieces, into records, by the lengths that these state.

    Every piece comes with an END. Where a file's last payload ends in line ends of its own, END was found among these, so
    the file's rest gets one too many: what is left then does not begin a record.
    """

    def __init__(self):
        self.held, self.place = bytearray(), 0

    def feed(self, piece: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
        """(place, length, header, block) of every record that the piece completes."""
        self.held += piece
        while self.held.startswith(b"WARC/"):
            head = self.held.find(b"\r\n\r\n")
            if head < 0:
                return
            fields = dict(line.split(b": ", 1) for line in bytes(self.held[:head]).split(b"\r\n")[1:])
            size = head + 4 + int(fields[b"Content-Length"])
            if len(self.held) < size + 4:
                return
            yield self.place, size + 4, fields, bytes(self.held[head + 4 : size])
            del self.held[: size + 4]
            self.place += size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries (CAPTURE) of all archives; lengths and digests of responses are taken from the payloads read."""
    names = [f.split()[0] for f in CAPTURE.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in CAPTURE.split(", ")]
    fields = [pa.field(n, k) for n, k in zip(names, kinds, strict=True) if n != "urlkey"]

    def page(value: bytes | None) -> int | None:
        found = _PAGE.fullmatch(value or b"")
        return int(found[1]) if found and found[1] else None

    def entry(run: str, place: int, length: int, f: dict, block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, kind = f[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), f[b"WARC-Type"].decode()
        size = int(http.rpartition(b"Content-Length: ")[2])
        if kind == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        who = page(f[b"WARC-Record-ID"])
        return START + (who or 0), who, f[b"WARC-Target-URI"].decode(), kind, page(f.get(b"WARC-Refers-To")), size, digest, run, place, length

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current = _Reader(), None
        for batch in batches:
            rows = []
            for run, value in zip(batch.column("run").to_pylist(), batch.column("value"), strict=True):
                if run != current:
                    reader, current = _Reader(), run
                rows += [entry(run, *r) for r in reader.feed(value.as_buffer().to_pybytes() + END.encode())]
            columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))

    # A compressed file is read by one task from its first line to its last, so pieces come in order.
    pieces = spark.read.option("lineSep", END).text(path).select("value", F.col("_metadata.file_name").alias("run"))
    out = pieces.mapInArrow(parsed, ", ".join(f for f in CAPTURE.split(", ") if not f.startswith("urlkey")))
    return out.withColumn("urlkey", url_key(F.col("url"))).select(*names)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, so the next winner takes log k comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.at = runs, key, [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None
        return self.heads[a] < self.heads[b] or self.heads[a] == self.heads[b] and a < b

    def _play(self, leaf: int) -> None:
        """From the leaf up: the loser stays, the winner goes on; an empty seat is filled while the tree is built."""
        node, who = (leaf + len(self.runs)) // 2, leaf
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = who
                return
            if self._beats(self.losers[node], who):
                self.losers[node], who = who, self.losers[node]
            node //= 2
        self.losers[0] = who

    def __iter__(self):
        if not self.runs:
            return
        while True:
            who = self.losers[0]
            if self.heads[who] is None:
                return
            yield self.runs[who][self.at[who]]
            self.at[who] += 1
            more = self.at[who] < len(self.runs[who])
            self.heads[who] = self.key(self.runs[who][self.at[who]]) if more else None
            self._play(who)


def merge_index(entries: DataFrame, per_task: int = MERGED) -> DataFrame:
    """entries in global order of (urlkey, seconds, page_id): partitions are ascending ranges, each merged from its runs."""
    names = entries.columns
    run, key = names.index("run"), [names.index(n) for n in ("urlkey", "seconds", "page_id")]
    schema = pa.schema([pa.field(n, pa.string() if t == "string" else pa.int64()) for n, t in entries.dtypes])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs.setdefault(row[run], []).append(row)
        tree = LoserTree(list(runs.values()), lambda r: (r[key[0]].encode(), r[key[1]], r[key[2]] is not None, r[key[2]] or 0))
        rows = []
        for row in tree:
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    ranges = max(1, -(-entries.count() // per_task))
    order = ["urlkey", "seconds", "page_id"]
    # The shuffle promises no order, so every run's share of a range is put back in order before the merge.
    return entries.repartitionByRange(ranges, *order).sortWithinPartitions("run", *order, "place").mapInArrow(merged, entries.schema)


def archive(pages: DataFrame, path: str) -> DataFrame:
    """Writes pages as archives at path and returns their merged capture index."""
    write_archives(records(pages), path)
    return merge_index(stored(read_archives(pages.sparkSession, path), "op8-entries"))


def op8_web_archive(spark, sf_dir: str) -> DataFrame:
    captures = archive(table(spark, sf_dir, "pages"), new_path(spark, "op8-archives"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_SQL = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
r as (select page_id, octet_length(encode(payload))::bigint as payload_bytes, sha1(payload) as payload_digest from p),
f as (select payload_digest, max(page_id) as first from r where payload_bytes >= {LEAST} group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page_id <> first then 'revisit' else 'response' end as record_type, case when page_id <> first then first end as refers_to
from r left join f using (payload_digest)"""

QUERIES = {"op8_web_archive": op8_web_archive}
SQL = {"op8_web_archive": _SQL}
