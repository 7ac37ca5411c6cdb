"""WARC archives with resolved revisits.

Only headers (id, digest, length) are shuffled by payload digest.  The
largest id of each digest group is the response, the others become revisit
records that refer to it.  Payloads meet the revisit list in the scan: a list
of at most ``BROADCAST_ROWS`` rows is broadcast; of a longer one a filter of
its ids is, of bounded size, and only payloads whose id may be in it meet the
exact list in a shuffle.  Archives are written by Spark as gzip-compressed
WARC 1.1 files in the shared folder, in classes of payload size so that a
file's bytes are bounded, and read back record by record while they are
decompressed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import scratch_path, stored, table
from snapmetrics.llm.lines import PART_BITS, filter_bits, id_filter, mapped_hits

#: Payloads below this many bytes are always written whole.
MIN_REVISIT_BYTES = 1000
#: Classes of payload size (bytes, exclusive) with their records per file: a
#: file holds at most about 320 MB, or one larger record.
SIZE_CLASSES = [(1 << 16, 5000), (1 << 24, 20), (1 << 62, 1)]
#: Most rows of a revisit list that is broadcast whole (some 30 MB).
BROADCAST_ROWS = 200_000
#: Bytes of parsed records that a reading task hands on at a time.
READ_BYTES = 1 << 22
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(rid, uri, payload); a null payload is empty."""
    return pages.select(
        F.col(id_col).cast("long").alias("rid"),
        F.col(url_col).cast("string").alias("uri"),
        F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("payload"),
    )


def _headers(recs: DataFrame) -> DataFrame:
    return recs.select(
        "rid", F.octet_length("payload").cast("long").alias("bytes"), F.sha1(F.col("payload").cast("binary")).alias("digest")
    )


def revisits(recs: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(rid, digest, refers_to) of the records to write as revisits.

    The aggregate is combined before its shuffle, so a digest that a third of
    all records share arrives as one row per task.  The groups are written
    before the join back, so that both its sides are plain exchanges and Spark
    may split the hot digests among the headers.  Records without an id,
    and repeated rows of the response's id, stay responses.
    """
    heads = _headers(recs).where(F.col("bytes") >= min_bytes)
    groups = (
        heads.groupBy("digest", "bytes")
        .agg(F.max("rid").alias("refers_to"), F.min("rid").alias("least"))
        .where(F.col("least") < F.col("refers_to"))
        .drop("least")
    )
    return (
        heads.join(stored(groups, "digest-groups"), ["digest", "bytes"])
        .where(F.col("rid") < F.col("refers_to"))
        .select("rid", "digest", "refers_to")
        .distinct()
    )


def _field(name: str, value: Column) -> Column:
    """A header line; a null value has none.  Line breaks and other control
    characters are percent-encoded away."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1f\x7f]", "%20"), F.lit("\r\n")), F.lit(""))


def _urn(rid: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(rid.cast("string"), F.lit("none")), F.lit(">"))


def warc_text(rid: Column, uri: Column, payload: Column, digest: Column, refers_to: Column) -> Column:
    """One whole record but for the last line break, which the writer adds."""
    revisit = refers_to.isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, payload))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _urn(rid)),
        _field("WARC-Date", F.lit(WARC_DATE)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _field("WARC-Refers-To", F.when(revisit, _urn(refers_to))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit("\r\n"),
    )


def write_archives(recs: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Resolve the revisits of ``recs`` (rid, uri, payload) and write WARC
    files under ``path``.

    The revisit list is written first, so Spark knows its size: it is
    broadcast below Spark's own threshold and else joined by a shuffle.
    """
    _write(recs.withColumn("refers_to", F.lit(None).cast("long")), stored(revisits(recs, min_bytes), "revisits"), path)


def _write(recs: DataFrame, found: DataFrame, path: str) -> None:
    """Write ``recs`` (rid, uri, payload, refers_to); those in ``found`` (rid,
    digest, refers_to) become revisits, as do those that refer already (their
    ``digest`` is kept, if ``recs`` has one)."""
    sha = F.sha1(F.col("payload").cast("binary"))
    body = recs.withColumn("digest", F.coalesce("digest", sha) if "digest" in recs.columns else sha)
    found = found.withColumnRenamed("refers_to", "original")
    n_found = found.count()
    if n_found > BROADCAST_ROWS:
        bits = filter_bits(n_found, PART_BITS)
        ids = id_filter(found.select(F.col("rid").alias("doc_id")), bits)

    def resolved(part: DataFrame) -> DataFrame:
        if n_found <= BROADCAST_ROWS:
            joined = part.join(F.broadcast(found), ["rid", "digest"], "left")
        else:
            maybe = mapped_hits(part, ids, bits, "rid")
            joined = maybe(False).withColumn("original", F.lit(None).cast("long"))
            joined = joined.unionByName(maybe(True).join(found, ["rid", "digest"], "left"))
        return joined.withColumn("refers_to", F.coalesce("refers_to", "original"))

    own, least = F.octet_length("payload"), 0
    written = F.when(F.col("refers_to").isNull(), own).otherwise(F.lit(0))
    top = recs.agg(F.max(own)).first()[0] or 0
    for limit, per_file in SIZE_CLASSES:
        if least <= top:
            # Revisits hold no payload and are all written with the smallest.
            one = resolved(body.where(own >= least) if least else body).where((written >= least) & (written < limit))
            one.select(warc_text(F.col("rid"), F.col("uri"), F.col("payload"), F.col("digest"), F.col("refers_to")).alias("value")).write.mode(
                "append"
            ).option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
        least = limit


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, payload) of each record of an uncompressed archive that
    comes in pieces; what is held is one record and one piece."""
    pieces, held = iter(pieces), bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        if not fill(5) or held[:5] != b"WARC/":
            raise ValueError("no WARC record where one should start")
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(seen - 3, 0))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError("a WARC header without an end")
        fields = dict(x.split(": ", 1) for x in held[:end].decode().split("\r\n")[1:])
        start, size = end + 4, int(fields["Content-Length"])
        if not fill(start + size):
            raise ValueError("a WARC record without an end")
        body = held.find(b"\r\n\r\n", start, start + size)
        yield fields, bytes(held[start + size if body < 0 else body + 4 : start + size])
        fill(start + size + 4)
        del held[: start + size + 4]


READ_SCHEMA = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("uri", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("refers_to", T.LongType()),
])
_URN = re.compile(r"<urn:page:(\d+|-\d+)>")


def _id(urn: str | None) -> int | None:
    m = _URN.fullmatch(urn or "")
    return int(m[1]) if m else None


def unzipped(data: bytes, piece: int = READ_BYTES) -> Iterator[bytes]:
    """The contents of all gzip members of a file, in pieces; other files as
    they are."""
    view = memoryview(data)
    if view[:2] != b"\x1f\x8b":
        yield from (bytes(view[a : a + piece]) for a in range(0, len(view), piece))
        return
    d = zlib.decompressobj(31)
    feed, at = b"", 0
    while feed or at < len(view) or not d.eof:
        if not feed:
            feed, at = bytes(view[at : at + piece]), at + piece
            if not feed:
                raise ValueError("a gzip file without an end")
        yield d.decompress(feed, piece)
        feed = d.unconsumed_tail
        if d.eof:
            feed = d.unused_data
            if not feed and at >= len(view):
                return
            d = zlib.decompressobj(31)


def _reader(with_payload: bool):
    schema = pa.schema([("rid", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("bytes", pa.int64()),
                        ("refers_to", pa.int64())] + [("payload", pa.string())] * with_payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for f, body in parse(unzipped(content.as_py())):
                    response = f["WARC-Type"] == "response"
                    rows.append({
                        "rid": _id(f["WARC-Record-ID"]), "uri": f.get("WARC-Target-URI"), "record_type": f["WARC-Type"],
                        # A response's digest and length are those of the payload as read.
                        "digest": hashlib.sha1(body).hexdigest() if response else f["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "bytes": len(body) if response else None, "refers_to": _id(f.get("WARC-Refers-To")),
                    } | ({"payload": body.decode()} if with_payload else {}))
                    held += len(body) if with_payload else 500
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of the WARC files under ``path``; revisits have no length (and
    no payload) of their own, see ``resolve``."""
    schema = T.StructType(READ_SCHEMA.fields + [T.StructField("payload", T.StringType())] * payload)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_reader(payload), schema)


def resolve(heads: DataFrame) -> DataFrame:
    """Give each revisit the length of the response that it refers to."""
    kept = heads.where(F.col("record_type") != "revisit")
    refs = kept.groupBy(F.col("rid").alias("refers_to"), "digest").agg(F.max("bytes").alias("full"))
    again = heads.where(F.col("record_type") == "revisit").join(refs, ["refers_to", "digest"], "left")
    cols = ["rid", "uri", "record_type", "digest", "refers_to"]
    return kept.select(*cols, "bytes").unionByName(again.select(*cols, F.col("full").alias("bytes")))


def deduplicate_archives(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Read archives, resolve the repeats among their responses and write new
    archives with fresh headers.

    A revisit is rebuilt from the response with its reference and digest; one
    whose response is not among the archives stays a revisit with its own
    digest and reference, so no record is lost.  Only the payloads that
    revisits ask for are joined.
    """
    recs = stored(read_archives(spark, source, payload=True), "archive-records")
    full = recs.where(F.col("record_type") == "response").select("rid", "uri", "payload", "digest")
    again = recs.where(F.col("record_type") == "revisit").select("rid", "uri", "digest", "refers_to")
    asked = again.select(F.col("refers_to").alias("rid"), "digest").distinct()
    bodies = full.join(asked, ["rid", "digest"], "left_semi").dropDuplicates(["rid", "digest"])
    bodies = bodies.select(F.col("rid").alias("refers_to"), "digest", "payload")
    rebuilt = again.join(bodies, ["refers_to", "digest"], "left")
    whole = full.select("rid", "uri", "payload").unionByName(rebuilt.where(F.col("payload").isNotNull()).select("rid", "uri", "payload"))
    lone = rebuilt.where(F.col("payload").isNull()).select("rid", "uri", F.lit("").alias("payload"), "refers_to", "digest")
    named = whole.withColumns({"refers_to": F.lit(None).cast("long"), "digest": F.lit(None).cast("string")})
    _write(stored(named.unionByName(lone), "rebuilt-records"), stored(revisits(whole, min_bytes), "revisits"), target)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, then answer from the archives.

    Null html is an empty payload; a null url leaves the URI line out; a page
    without an id is a response.  Repeated rows of the response's own id are
    responses too.
    """
    path = scratch_path(spark, "warc")
    write_archives(records(table(spark, sf_dir, "pages")), path)
    heads = stored(read_archives(spark, path), "warc-headers")
    return resolve(heads).select(
        F.col("rid").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to",
    )
