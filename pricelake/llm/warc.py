"""WARC archives: writing with de-duplicated payloads, and reading by boundary-chain verification.

Writing.  A page is an HTTP response record whose payload is its HTML; of pages with equal payloads
of at least ``least`` bytes only that with the smallest id keeps it, the others are revisit records
that refer to it.  Payloads meet by SHA-256 in a partial aggregate; the digests that occur more
than once are matched with the pages by broadcast up to MANY of them (100 bytes each), else by a
join.  Records are written by Spark's text sink, whose line separator is the record separator.

Reading.  Files are read in blocks by independent tasks.  A task cannot know where a record begins:
it takes every place that looks like a record header, also inside payloads, and follows each one's
content length to its successor, through the block and out of it.  The hops between blocks are
then followed by pointer jumping from the start of each file: in every round the places reached
are joined with the jumps, and the jumps with themselves, so the number of rounds grows with the
logarithm of the blocks of a file.  Only the places reached hold records; they are read from there.
Each block is a task's work, up to TASKS tasks.  One block and one record are held in a task; a header that ends beyond the block is read to its end,
however long it is.

Cases: null HTML is an empty payload; a null page_id is written without one, never chosen before
another id, and read back as null; if all ids of a payload are null, all are responses; rows that
share the smallest id of a payload are all responses; line ends in a URL become blanks, a null URL
is left out; a file that does not begin with a record holds none; where a chain breaks (foreign bytes,
a record cut short) the file's records end with the last whole one before, and ``file_report``
names the file; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .files import blocks, dealt, grouped, read

VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"
BLOCK, HEADER = 4 << 20, 1 << 16
MANY = 100_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(pages: DataFrame, path: str, least: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    rows = pages.select("page_id", F.translate("url", "\r\n", "  ").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    firsts = stored(rows.where(F.col("size") >= least).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                    .where("n > 1 and first is not null").select(F.col("digest").alias("_digest"), "first"), "warc-firsts")
    firsts = F.broadcast(firsts) if firsts.count() <= MANY else firsts
    rows = rows.join(firsts, (F.col("digest") == F.col("_digest")) & (F.col("size") >= least), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(F.concat(F.lit("page "), F.coalesce(c.cast("string"), F.lit("")), F.lit(" "), F.col("digest")).cast("binary")),
        "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))
    line = lambda key, value: F.when(value.isNotNull(), F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    rows = rows.withColumn("block", block).withColumn("again", again)
    record = F.concat(
        F.lit(VERSION.decode()), line("WARC-Type", F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("size").cast("string")), line("X-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Profile", F.when(F.col("again"), F.lit(REVISIT))),
        line("WARC-Refers-To", F.when(F.col("again"), name(F.col("first")))),
        line("X-Refers-To-Page-ID", F.when(F.col("again"), F.col("first").cast("string"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"), F.col("block"))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "none").text(path)


def header(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Fields (lower-case names) of the header at a place, and where its content begins."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    lines = data[at + len(VERSION):end].split(b"\r\n")
    fields = {}
    for x in lines:
        key, colon, value = x.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def unfinished(data: bytes, last: int) -> bool:
    """Whether a place before ``last`` may be a record whose header goes on after ``data``."""
    at = data.find(VERSION, data.rfind(b"\r\n\r\n") + 1)
    while 0 <= at < last:
        if all(b":" in x for x in data[at + len(VERSION):].split(b"\r\n")[:-1]):
            return True
        at = data.find(VERSION, at + 1)
    return False


def read_block(uri: str, first: int, last: int, length: int) -> bytes:
    """Bytes from ``first`` on to the end of every header that begins before ``last``."""
    data = read(uri, first, min(last + HEADER, length))
    while first + len(data) < length and unfinished(data, last - first):
        data += read(uri, first + len(data), min(first + 2 * len(data), length))
    return data


def candidates(data: bytes, first: int, last: int) -> list[tuple[int, int]]:
    """(place, successor) of every place in first .. last that looks like a record; ``data`` begins
    at ``first`` and holds the whole header of each."""
    out, at = [], data.find(VERSION)
    while 0 <= at < last - first:
        if found := header(data, at):
            out.append((first + at, first + found[1] + int(found[0]["content-length"]) + len(END)))
        at = data.find(VERSION, at + 1)
    return out


def chains(found: list[tuple[int, int]], last: int, length: int) -> list[tuple[int, int | None, int]]:
    """(place, exit, stop) of every candidate of a block that ends at ``last``, in a file of ``length``
    bytes: the first place after the block on its chain (none if the chain ends in the block), and
    where its last whole record there ends.  A record is whole if all of its content is there."""
    out: dict[int, tuple[int | None, int]] = {}
    for place, after in reversed(found):
        if after - len(END) > length:           # content is missing
            out[place] = None, place
        elif after > length:                    # only the record's end mark is cut
            out[place] = None, after - len(END)
        elif after >= last:
            out[place] = after, after
        else:
            out[place] = out.get(after, (None, after))
    return [(place, *x) for place, x in out.items()]


def entries(spark: SparkSession, path: str, size: int = BLOCK) -> DataFrame:
    """path, length (of the file), place, exit, stop: where the records of each block that holds some
    begin, the first place after the block (null if the chain ends before) and the end of the
    block's last whole record."""
    files = blocks(spark, path, size)
    names = ["path", "length", "place", "exit", "stop"]

    def scan(batches):
        for batch in batches:
            for uri, length, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                found = chains(candidates(read_block(uri, first, last, length), first, last), last, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(found), pa.string()), pa.array([length] * len(found), pa.int64()),
                     *(pa.array([x[k] for x in found], pa.int64()) for k in range(3))], names=names)

    places = stored(files.mapInArrow(scan, "path string, length long, place long, exit long, stop long"), "warc-places")
    # entries: places where some chain arrives, or a file begins
    arrivals = places.where("exit < length").select("path", F.col("exit").alias("place")).distinct()
    known = stored(places.where("place = 0").unionByName(places.join(arrivals, ["path", "place"], "left_semi").where("place > 0").select(*names)),
                   "warc-entries")
    jumps = known.where("exit < length").select("path", "place", "exit")
    reached = known.where("place = 0").select("path", "place")
    count = reached.count()
    while True:
        step = reached.join(jumps, ["path", "place"]).select("path", F.col("exit").alias("place"))
        more = stored(reached.unionByName(step).distinct().join(known, ["path", "place"], "left_semi"), "warc-reached")
        n = more.count()
        if n == count:
            break
        reached, count = more, n
        jumps = stored(jumps.join(jumps.select("path", F.col("place").alias("exit"), F.col("exit").alias("next")), ["path", "exit"])
                       .select("path", "place", F.col("next").alias("exit")), "warc-jumps")
    return stored(reached.join(known, ["path", "place"]).select(*names), "warc-found")


def file_report(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """path, length, read_to, whole of every non-empty file, given its ``entries``: how far its records
    go, and whether they reach its end."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    met = found.groupBy(F.col("path").alias("_path")).agg(
        F.max("stop").alias("stop"), F.max(F.coalesce(F.col("exit") == F.col("length"), F.lit(False))).alias("end"))
    return files.join(met, F.col("path") == F.col("_path"), "left").select(
        "path", "length", F.coalesce("stop", F.lit(0)).cast("long").alias("read_to"), F.coalesce("end", F.lit(False)).alias("whole"))


def read_records(spark: SparkSession, path: str, size: int = BLOCK, strict: bool = False) -> DataFrame:
    """Every record: path, place, record_type, page_id, refers_to, uri, record_id, stated_digest,
    stated_length, payload (null for revisits).  ``strict``: a file that is broken is an error."""
    found = entries(spark, path, size)
    if strict:
        broken = file_report(spark, path, found).where("not whole").orderBy("path")
        if n := broken.count():
            raise ValueError(f"{n} broken files, the first after byte {broken.first()['read_to']}: {broken.first()['path']}")
    names = ["path", "place", "record_type", "page_id", "refers_to", "uri", "record_id", "stated_digest", "stated_length", "payload"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def records(uri, first, last):
        data, at = read(uri, first, last), 0
        while at < len(data):
            fields, begin = header(data, at)
            end = begin + int(fields["content-length"])
            kind = fields.get("warc-type")
            payload = None
            if kind != "revisit":
                payload = data[begin:end]
                if fields.get("content-type", "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            number = lambda key: int(fields[key]) if key in fields else None
            yield len(payload or b""), (
                uri, first + at, kind, number("x-page-id"), number("x-refers-to-page-id"), fields.get("warc-target-uri"),
                fields.get("warc-record-id"), fields.get("warc-payload-digest"), number("x-payload-length"), payload)
            at = end + len(END)

    def run(batches):
        for batch in batches:
            for uri, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                for held in grouped(records(uri, first, last), 1 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    rows = found.where("stop > place")
    return (dealt(rows.select("path", "place", "stop"), rows.count()).mapInArrow(
        run, "path string, place long, record_type string, page_id long, refers_to long, uri string, record_id string, "
             "stated_digest string, stated_length long, payload binary"))


def digest_report(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest (both of the full payload), record_type, refers_to."""
    full = F.col("payload").isNotNull()
    return records.select(
        "page_id", F.when(full, F.octet_length("payload")).otherwise(F.col("stated_length")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.regexp_replace("stated_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type", "refers_to")


SQL = """
with page as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
first as (
  select payload_digest, min(page_id) as first from page where payload_bytes >= 100 group by payload_digest)
select p.page_id, p.payload_bytes::bigint as payload_bytes, p.payload_digest,
       case when f.first is not null and p.page_id is distinct from f.first then 'revisit' else 'response' end as record_type,
       case when f.first is not null and p.page_id is distinct from f.first then f.first end as refers_to
from page p left join first f on f.payload_digest = p.payload_digest and p.payload_bytes >= 100
"""
