"""WARC archives of web pages, and their index by external merge.

Spark's text writer makes the archives: a record without its end is a row, and the two line ends
that close a record are the line separator. So the files are WARC on every store Spark can write,
and a repeated task leaves no half file. Records with equal payloads revisit the first.

Reading an archive gives a run of index lines, sorted by url key and time. Runs are written, then
merged: ranges of (key, time) hold a slice of each run, and a loser tree merges a range's slices.
The ranges in order are the capture histories of all urls.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table
from lakeops.session import scratch_dir

END = "\r\n\r\n"
RECORDS_PER_FILE = 5_000
ARCHIVE_BYTES = 64 << 20  # an archive is read back as one cell
HEADER_BYTES = 1_024  # of a record, without its uri
MIN_REVISIT_BYTES = 100
RANGE_ROWS = 50_000
MAX_BROADCAST_ROWS = 100_000  # of repeated payloads' digests, about 150 bytes each
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _first_captures(pages: DataFrame, min_bytes: int) -> DataFrame:
    """digest and least id of payloads that occur more than once; counted before the shuffle."""
    return (pages.where(F.col("bytes") >= min_bytes).groupBy("digest")
            .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def _record(date: Column) -> Column:
    """A record's text without the line ends that close it; a null field leaves its line out."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    return F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(""), block)


def _size_classes(sizes: DataFrame, records_per_file: int) -> list[tuple[int, int, int]]:
    """(least size, size beyond, records for a file) of records that are written together.

    So many of the largest of a class fill an archive at most; only one larger than an archive may
    exceed it. `sizes` are measured by one aggregate, a row for each power of four.
    """
    power = F.ceil(F.log2(F.col("size").cast("double")) / 2).cast("int")
    found = sorted(r["power"] for r in sizes.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect())
    classes = {}
    for k in found:
        n = max(1, min(records_per_file, ARCHIVE_BYTES >> 2 * k))
        least = classes.get(n, (4 ** (k - 1) + 1,))[0]
        classes[n] = (least, 4 ** k + 1, n)
    return list(classes.values())


def write_archives(pages: DataFrame, path: str, date: Column, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row; `date` is its time (UTC), from columns of `pages`.

    Of equal payloads of at least `min_bytes`, the one with the least id is a response and the others
    revisit it; rows that repeat the least id are responses, too. Null payloads are empty; a null url
    leaves its line out; a null id is never the least, unless all are null, when each is a response.
    An empty table leaves an empty folder; other columns aren't read. An archive has at most
    `records_per_file` records and some 64 MB: large records are written class by class of sizes,
    each with fewer records a file.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").alias("uri"),
                        date.alias("date"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    firsts_path = scratch_dir(pages.sparkSession, "payloads")
    _first_captures(rows.select("id", "digest", "bytes"), min_bytes).write.parquet(firsts_path)
    firsts = pages.sparkSession.read.parquet(firsts_path)
    if firsts.count() <= MAX_BROADCAST_ROWS:  # else the payloads are shuffled by digest
        firsts = F.broadcast(firsts)
    marked = rows.join(firsts, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    size = F.col("bytes").cast("bigint") + 3 * F.coalesce(F.octet_length("uri"), F.lit(0)) + HEADER_BYTES  # an uri's line ends are escaped
    classes = _size_classes(rows.select(size.alias("size")), records_per_file)
    for least, beyond, records in classes or [(0, 0, records_per_file)]:
        mine = marked.where((size >= least) & (size < beyond)) if len(classes) > 1 else marked
        (mine.select(_record(F.col("date")).alias("value")).write.mode("append").option("lineSep", END)
         .option("maxRecordsPerFile", records).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """(header fields, offset, length, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head_end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = head_end + 4
        end = begin + int(fields["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} doesn't end where it should")
        yield fields, at, end + 4 - at, data[begin:end]
        at = end + 4


def url_key(uri: str | None) -> str:
    """The host's labels turned round, then the rest without the fragment: `net,example)/en/1`."""
    if not uri or "://" not in uri:
        return uri or ""
    rest = uri.split("://", 1)[1].split("#", 1)[0]
    cut = min([i for i in map(rest.find, "/?") if i >= 0], default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


INDEX = ("run string, url_key string, timestamp string, page_id bigint, uri string, record_type string, "
         "payload_digest string, payload_bytes bigint, refers_to bigint, offset bigint, length bigint")
NAMES = [x.split()[0] for x in INDEX.split(", ")]
ARROW = pa.schema([(x.split()[0], pa.int64() if x.endswith("bigint") else pa.string()) for x in INDEX.split(", ")])


def _urn_id(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _line(run: str, fields: dict[str, str], offset: int, length: int, block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.lower().partition(b"content-length:")[2].split(b"\r\n")[0])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload at {offset} of {run}")
    uri = fields.get("warc-target-uri")
    stamp = "".join(c for c in fields.get("warc-date", "") if c.isdigit())
    return (run, url_key(uri), stamp, _urn_id(fields["warc-record-id"]), uri, fields["warc-type"], digest, size,
            _urn_id(fields.get("warc-refers-to")), offset, length)


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index lines of each archive (`INDEX`), sorted by url key, time and id within their run.

    Payloads are checked against their digests.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = sorted((_line(run, *x) for x in parse_records(content.as_buffer().to_pybytes())), key=_order)
                yield _batch(lines)

    return files.mapInArrow(index, INDEX)


def _order(line: tuple) -> tuple:
    """Url key, time, id (null first), place in the run."""
    return line[1], line[2], -1 if line[3] is None else line[3], line[9]


def _batch(lines: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*lines)) if lines else [[]] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types)], schema=ARROW)


class LoserTree:
    """Merges sorted iterables: each inner node keeps the loser of its match, and the winner goes up."""

    def __init__(self, runs: Iterable[Iterable[tuple]], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(self.runs))
        self.heads: list[tuple | None] = [None] * self.k  # (key, run, line); None: used up
        for i in range(len(self.runs)):
            self._next(i)
        self.losers = [0] * self.k
        self.winner = self._play(1)

    def _next(self, i: int) -> None:
        line = next(self.runs[i], None)
        self.heads[i] = None if line is None else (self.key(line), i, line)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and x[:2] < y[:2]

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.winner] is not None:
            yield self.heads[self.winner][2]
            at, node = self.winner, (self.winner + self.k) // 2
            self._next(at)
            while node:
                if self._beats(self.losers[node], at):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS, batch_rows: int = 5_000) -> DataFrame:
    """All runs in one global order of url key, time and id; give a written table of runs.

    A url with very many captures is cut by time and id like any other range, so that no task gets
    more than a range's rows.
    """
    ranges = max(1, -(-runs.count() // range_rows))
    dealt = (runs.repartitionByRange(ranges, "url_key", "timestamp", "page_id", "run", "offset")
             .sortWithinPartitions("run"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                slices.setdefault(line[0], []).append(line)
        for lines in slices.values():  # the shuffle may deal a run's blocks in any order
            lines.sort(key=_order)
        held = []
        for line in LoserTree([slices[r] for r in sorted(slices)], _order):
            held.append(line)
            if len(held) == batch_rows:
                yield _batch(held)
                held = []
        yield _batch(held)

    return dealt.select(*NAMES).mapInArrow(merge, INDEX)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


@query("op6_warc", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, archives, runs = table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"), scratch_dir(spark, "runs")
    # The pages have no time of capture: one second for each page.
    date = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    write_archives(pages, archives, date)
    index_runs(spark, archives).write.parquet(runs)
    return merge_runs(spark.read.parquet(runs)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
