"""Deterministic sharded WARC writer and reader.

Equal payloads are found by digest before anything is written: the row with the largest id
becomes the response, the others revisit it. Rows are ordered by id and digest and cut into
shards of equal bytes by running sums over range partitions, so the same table always gives the
same files. The start of each shard travels as a mark among the rows. A task writes its run of
shards to temporary names, rolls to a new file when the compressed size is reached, and reports
what it wrote. Only reported files are renamed and listed in the manifest; files of attempts that were
lost or repeated stay in the temporary folder, which goes at the end.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cinestrata.llm.common import narrowed, pieces
from cinestrata.session import materialised

DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
READ = 1 << 20
TASKS = 50_000       # tasks of the writer, each with one shard or a run of them
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-record")
_SHARD, _REVISIT, _PAGE = range(3)      # marks come before the rows that they belong to
_FILES = "shard long, part long, file string, written string, records long, bytes long, sha256 string"
_RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long")


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    """A header value without line breaks and other controls."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record, compressed as a member of its own. A revisit keeps only its payload's length."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    sha = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha}",
              "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}",
                  f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[bytes]:
    """The members of a gzip stream, one after another."""
    unpacker, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(READ)
        if not data:
            if parts:
                raise ValueError("archive ends within a record")
            return
        parts.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            yield b"".join(parts)
            data = unpacker.unused_data
            unpacker, parts = zlib.decompressobj(31), []


def parsed(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """Id, payload length, payload digest, type and target id of a record, checked by digest."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if revisit:
        told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
        length = int(told["Content-Length"])
    else:
        length = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    number = lambda name: int(fields[name]) if fields.get(name, "None") != "None" else None
    return (number("X-Page-ID"), length, digest, fields["WARC-Type"],
            number("X-Refers-To-Page-ID"))


def _revisits(digests: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, sha, first`` of the rows that revisit another, once each."""
    shared = (digests.where(F.col("length") >= least_bytes).groupBy("sha")
              .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("sha", "first"))
    return digests.join(shared, "sha").where(
        ~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", "sha", "first").distinct()


def shard_starts(digests: DataFrame, shard_bytes: int) -> DataFrame:
    """``shard`` and the least ``page_id, sha`` of it.

    Half of a place is its share of the bytes, half that of the records, so a shard has at most
    twice ``shard_bytes`` and twice its part of the records, but for the last key in it. Rows of
    one id or without one are told apart by digest. Ranges of the keys are summed up by themselves
    and shifted by what stands before them, so the result depends on the table alone.
    """
    key = [F.col("page_id"), F.col("sha")]
    placed = materialised(
        digests.groupBy("page_id", "sha").agg(F.sum("length").alias("bytes"),
                                              F.count(F.lit(1)).alias("records"))
        .repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "page-keys")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as partitions.
    parts = placed.groupBy("part").agg(F.sum("bytes").alias("bytes"),
                                       F.sum("records").alias("records"))

    def sums(window) -> list[Column]:
        return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(c) for c in ("bytes", "records")]

    local = placed.select("part", *key, *sums(within)).alias("here").join(
        F.broadcast(parts.select("part", *sums(before)).alias("offset")), "part")
    total, records = parts.agg(F.sum("bytes"), F.sum("records")).first()
    shards = (total or 0) / shard_bytes
    place = ((F.col("here.bytes") + F.col("offset.bytes")) / float(shard_bytes)
             + (F.col("here.records") + F.col("offset.records")) * (shards / (records or 1))) / 2
    return local.groupBy(F.floor(place).cast("long").alias("shard")).agg(
        F.min(F.struct(*key)).alias("start")).select("shard", "start.page_id", "start.sha")


def place_among(bounds: list[tuple[int | None, str]], page_id: Column, sha: Column) -> Column:
    """How many of the ascending ``bounds`` are not above the key, by bisection; null ids come first."""
    listed = F.from_json(F.lit(json.dumps([{"p": p, "s": s} for p, s in bounds])),
                         "array<struct<p: bigint, s: string>>")
    key = F.struct(page_id.alias("p"), sha.alias("s"))
    steps = F.lit([1 << j for j in range(len(bounds).bit_length() - 1, -1, -1)])
    # Beyond the last bound there is nothing to compare with and the place stays.
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(listed, at + step - 1) <= key, at + step).otherwise(at))


def _writer(folder: str, temporary: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        attempt, out, shard, part = uuid.uuid4().hex, None, None, 0
        name, size, records, sha, mark = "", 0, 0, hashlib.sha256(), (None, None, None)
        now = None

        def done() -> pa.RecordBatch:
            out.close()
            row = {"shard": shard, "part": part, "file": name,
                   "written": f"{temporary}/{attempt}-{name}", "records": records, "bytes": size,
                   "sha256": sha.hexdigest()}
            return pa.RecordBatch.from_pylist([row])

        for batch in pieces(batches, "payload"):
            for r in batch.to_pylist():
                if r["kind"] == _SHARD:
                    now = r["number"]
                    continue
                if r["kind"] == _REVISIT:
                    mark = (r["page_id"], r["sha"], r["number"])
                    continue
                revisit = mark[:2] == (r["page_id"], r["sha"])
                if out is not None and (now != shard or size >= file_bytes):
                    yield done()
                    out = None
                if now != shard:
                    shard, part = now, -1
                if out is None:
                    part, size, records, sha = part + 1, 0, 0, hashlib.sha256()
                    name = f"pages-{shard:06d}-{part:05d}.warc.gz"
                    out = fs.open_output_stream(
                        f"{base}/{temporary}/{attempt}-{name}", compression=None)
                data = record(r["page_id"], r["url"], r["payload"], base32_digest(r["sha"]),
                              mark[2] if revisit else None, revisit, date)
                out.write(data)
                sha.update(data)
                size += len(data)
                records += 1
        if out is not None:
            yield done()

    return run


def _renamer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                source, target = f"{base}/{r['written']}", f"{base}/{r['file']}"
                if fs.get_file_info(source).type == pafs.FileType.File:
                    fs.move(source, target)
                elif fs.get_file_info(target).size != r["bytes"]:   # not renamed before either
                    raise FileNotFoundError(source)
            yield batch

    return run


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = 16 << 20,
                   file_bytes: int = 8 << 20, least_bytes: int = 0,
                   date: str = DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; the manifest of what was committed.

    ``folder`` must be a new or empty one that all executors reach. A null html is an empty
    payload, a null url leaves its header out, a null id is the smallest one and is left out of
    the header. Very long payloads are single rows of a task and may exceed a shard's or file's size.
    Payloads below ``least_bytes`` are always responses. Rows that share payload
    and the largest id are all responses. An empty table gives an empty manifest.
    """
    rows = narrowed(pages, page_id="long", url="string", html="string").select(
        "page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), "url")
    rows = rows.withColumn("sha", F.sha1("payload"))
    digests = materialised(rows.select("page_id", "sha", F.octet_length("payload").cast("long")
                                       .alias("length")), "page-digests")
    starts = materialised(shard_starts(digests, shard_bytes), "shard-starts")
    # Each task has ``run`` shards; the driver gets the starts of tasks, a bounded number.
    run = ((starts.agg(F.max("shard")).first()[0] or 0) // TASKS) + 1
    bounds = starts.groupBy(F.floor(F.col("shard") / run)).agg(
        F.min(F.struct("page_id", "sha")).alias("start")).orderBy("start").collect()
    bounds = [tuple(r["start"]) for r in bounds][1:]
    # Marks go the same way as the rows and sort before them: one shuffle of pages.
    none = F.lit(None)
    marks = starts.select("page_id", "sha", F.lit(_SHARD).alias("kind"),
                          F.col("shard").alias("number")).union(
        _revisits(digests, least_bytes).select("page_id", "sha", F.lit(_REVISIT), "first"))
    both = rows.select("page_id", "sha", F.lit(_PAGE).alias("kind"), none.cast("long").alias("number"),
                       "url", "payload").union(marks.select("*", none, none))
    task = place_among(bounds, F.col("page_id"), F.col("sha")) if bounds else F.lit(0)
    fs, base = pafs.FileSystem.from_uri(folder)
    temporary = "_temporary"
    fs.create_dir(f"{base}/{temporary}")
    # Numbered tasks: hashing would leave some empty and give others several.
    written = (both.withColumn("task", task.cast("int"))
               .repartitionById(len(bounds) + 1, F.col("task")).drop("task")
               .sortWithinPartitions("page_id", "sha", "kind", "url")
               .mapInArrow(_writer(folder, temporary, file_bytes, date), _FILES))
    pending = f"{folder}/_pending"
    written.write.parquet(pending)
    named = pages.sparkSession.read.parquet(pending)
    manifest = f"{folder}/_manifest"
    named.mapInArrow(_renamer(folder), _FILES).drop("written").write.parquet(manifest)
    fs.delete_dir(f"{base}/{temporary}")
    return pages.sparkSession.read.parquet(manifest)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the files that the manifest of ``folder`` lists, digests checked.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Files are streamed
    record by record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for name, records in zip(batch.column("file").to_pylist(),
                                     batch.column("records").to_pylist()):
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows = [parsed(m) for m in members(stream)]
                if len(rows) != records:
                    raise ValueError(f"{name} has {len(rows)} records, not {records}")
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], list(names))

    files = spark.read.parquet(f"{folder}/_manifest").select("file", "records")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "file").mapInArrow(run, _RECORDS)
