"""WARC archives of pages, read back and indexed.

Pages become WARC 1.1 records in gzip files of bounded size, each file a run sorted by url
key, time and page. Equal payloads are stored once: the largest page holds the response,
the others are revisit records that refer to it. Reading parses the files by their content
lengths, recomputes the digests and yields index lines in run order. The runs are cut into
the same ranges of keys, and every range is merged from its run slices by a loser tree, so
the range files together are one globally ordered capture history.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path
from .common import UPPER, lower_ascii, ship_code
from .url_graph import url_host

ship_code(__name__)

#: Records in a file: bounds what a reader holds at once.
FILE_RECORDS = 1000
#: Captures carry no time here; a page's is this many seconds after the epoch below plus its id.
FIRST_CAPTURE = 1_704_067_200
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("urlkey string, capture_time timestamp, page_id long, record_type string, payload_bytes long, "
         "payload_digest string, refers_to long, url string, run string, place long")
KEYS = ["urlkey", "capture_time", "page_id"]


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: every five hex digits are four characters."""
    letter = lambda five, shift: F.substring(F.lit(UPPER + "234567"), F.shiftright(five, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    group = lambda k: F.conv(F.substring(digest, F.lit(5) * k + 1, F.lit(5)), 16, 10).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.concat(
        *[letter(group(k), shift) for shift in (15, 10, 5, 0)])), "")


def url_key(url: Column) -> Column:
    """Sort-friendly form: reversed host, then the rest of the url in lower case."""
    host = F.array_join(F.reverse(F.split(url_host(url), r"\.")), ",")
    rest = lower_ascii(F.regexp_replace(F.coalesce(url, F.lit("")), r"^.*?://[^/?#]*", ""))
    return F.concat(host, F.lit(")"), rest)


def _header_text(value: Column) -> Column:
    """A value that keeps to its header line: line ends and percent signs are coded."""
    return F.replace(F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def equal_payloads(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Groups of two and more equal payloads: ``of_digest``, ``of_bytes``, ``kept`` (largest page)."""
    groups = pages.groupBy("digest", "bytes").agg(F.max("page_id").alias("kept"), F.count("*").alias("copies"))
    groups = groups.where((F.col("copies") > 1) & (F.col("bytes") >= least_bytes) & F.col("kept").isNotNull())
    return groups.select(F.col("digest").alias("of_digest"), F.col("bytes").alias("of_bytes"), "kept")


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``record`` (text of a WARC record without its closing line ends) and its sort keys.

    A NULL html is an empty payload. A row of the group's largest page is the response, also
    if that page comes twice; NULL pages and urls leave out their header lines.
    """
    html = F.coalesce("html", F.lit(""))
    page = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"),
                        F.octet_length(html).cast("long").alias("bytes"))
    groups = materialize(equal_payloads(page, least_bytes), "equal-payloads")
    page = page.join(groups, (F.col("digest") == F.col("of_digest")) & (F.col("bytes") == F.col("of_bytes")), "left")
    original = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")), F.col("kept"))
    time = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0)))
    page = page.select("page_id", "url", "html", "digest", "bytes", original.alias("original"),
                       time.alias("capture_time"), url_key(F.col("url")).alias("urlkey"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END + END))
    revisit = F.col("original").isNotNull()
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    identity = lambda page_id: F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.lit(END),
        _line("WARC-Record-ID", identity(F.col("page_id"))), _line("WARC-Target-URI", _header_text(F.col("url"))),
        _line("WARC-Date", F.date_format("capture_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _line("WARC-Refers-To", identity(F.col("original"))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", F.octet_length(block)), F.lit(END), block)
    return page.select(record.alias("record"), *KEYS)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Gzip files under ``path``; each is a run in the order of url key, time and page.

    Spark's text writer ends every row with the two line ends that close a record.
    """
    (records(pages, least_bytes).sortWithinPartitions(*KEYS).select("record")
     .write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an uncompressed archive."""
    at, view = 0, memoryview(data)
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8").split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head + 4
        at = start + int(fields["Content-Length"])
        yield fields, bytes(view[start:at])
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record not closed at byte {at}")
        at += 4


def _page(identity: str | None) -> int | None:
    return int(identity[len("<urn:page:"):-1]) if identity else None


def index_line(fields: dict[str, str], block: bytes) -> tuple:
    """Page, time, type, payload length and digest, original and url of a record; checks the digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(head.rpartition(b"Content-Length: ")[2])
    if fields["WARC-Type"] == "response":
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"payload of {fields.get('WARC-Record-ID')} does not have its digest")
    url = fields.get("WARC-Target-URI")
    return (_page(fields.get("WARC-Record-ID")), fields["WARC-Date"], fields["WARC-Type"], size, digest,
            _page(fields.get("WARC-Refers-To")),
            None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"))


def _read_files(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            data = zlib.decompressobj(wbits=31)
            lines = [index_line(*x) for x in parse_archive(data.decompress(content) + data.flush())]
            frame = pd.DataFrame(lines, columns=["page_id", "time", "record_type", "payload_bytes", "payload_digest", "refers_to", "url"])
            frame["page_id"], frame["refers_to"] = frame["page_id"].astype("Int64"), frame["refers_to"].astype("Int64")
            yield frame.assign(run=path.rpartition("/")[2], place=range(len(frame)))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index lines of all archives under ``path``, with their run (file) and place in it."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    lines = files.mapInPandas(_read_files, "page_id long, time string, record_type string, payload_bytes long, "
                                           "payload_digest string, refers_to long, url string, run string, place long")
    return lines.select(url_key(F.col("url")).alias("urlkey"), F.to_timestamp("time").alias("capture_time"), "page_id", "record_type",
                        "payload_bytes", "payload_digest", "refers_to", "url", "run", "place")


class LoserTree:
    """Merges sorted runs: inner nodes keep the losers of their matches, so that each step replays one path."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.at = runs, key, [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))]
        self.losers = [-1] * len(runs)
        self.winner = self._play(1) if runs else -1

    def _head(self, i: int):
        """Rank of a run's next item: exhausted runs come last, ties go to the earlier run."""
        return (0, self.key(self.runs[i][self.at[i]]), i) if self.at[i] < len(self.runs[i]) else (1, (), i)

    def _play(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self.heads[b] < self.heads[a]:
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.runs and not self.heads[self.winner][0]:
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            node = (i + len(self.runs)) // 2
            while node:
                if self.heads[self.losers[node]] < self.heads[i]:
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


def _merge_range(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merges a range: its rows come run by run, each run in order."""
    frames = list(batches)
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    pages = rows["page_id"].fillna(-1)
    keys = list(zip(rows["urlkey"], rows["capture_time"], rows["page_id"].notna(), pages))
    runs = list(rows.groupby("run", sort=False).indices.values())
    order = list(LoserTree([list(run) for run in runs], keys.__getitem__))
    yield rows.iloc[order].assign(turn=range(len(order)))


def merge_runs(lines: DataFrame) -> DataFrame:
    """Index lines in global order: ``key_range`` and ``turn`` (place in the range) are added.

    The range bounds cover url key, time and page, so the captures of one much-visited url
    or host spread over ranges; a task holds the index lines of one range, not their pages.
    """
    ranged = lines.repartitionByRange(*KEYS).sortWithinPartitions("run", "place")
    merged = ranged.mapInPandas(_merge_range, INDEX + ", turn long")
    return merged.withColumn("key_range", F.spark_partition_id())


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (``page_id``, ``url``, ``html``) as archives and returns their merged index.

    One line per row, other columns are not archived. An empty table gives no lines.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return merge_runs(materialize(read_archives(spark, path), "warc-index"))
