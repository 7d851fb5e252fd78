"""Web archive files with a two-level capture index.

Writing: every task appends its pages to one WARC file in the shared folder,
each record a gzip member of its own, and returns the place of each. Captures
are then sorted by reversed-host URL key and page id; each range of them
becomes an index file of compressed blocks, and the place and first key of
every block make up a sparse directory.

Reading: a lookup key is routed to its index file by binary search over the
files' first keys, to its block by binary search over the directory of that
file, and to its captures by binary search in the block; the records are then
read by range and decompressed one by one.

Of records with equal payloads of at least ``REVISIT_LEAST`` bytes, the one with
the largest page id holds the payload; the others are revisit records that
refer to it. Files carry a random name, and only those of committed tasks are
in the index, so a task that is run again leaves no wrong records.

Defined cases: null html is an empty payload; a null or malformed URL is kept
as it is under a key of its own; rows that share the largest page id of equal
payloads are all responses; a null page id is below all others (if all of a
group are null, all are responses); an empty table makes an empty archive.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import file_system, materialize, ship
from ledgerloom.session import scratch_dir

REVISIT_LEAST = 1000           # bytes
BLOCK_LINES = 1000             # captures in one index block
BROADCAST_ROWS = 200_000       # of a digest and an id: some MB
DATE = "2000-01-01T00:00:00Z"  # pages carry no capture time
CAPTURE = "key string, page_id long, file string, offset long, length long"

URL = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)(:[0-9]*)?([^#]*)")


def url_key(url: str | None) -> str:
    """The host's labels from the right, then path and query: ``com,example,www)/path?query``."""
    m = URL.match(url or "")
    if not m or not m[1]:
        return ")" + (url or "")
    host = m[1].lower()
    if not host.startswith("[") and not re.fullmatch(r"[0-9.]+", host):
        host = ",".join(reversed(host.rstrip(".").split(".")))
    port = "" if m[2] in (None, ":", ":80", ":443") else m[2]
    return f"{host}{port}){m[3] or '/'}"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP header of the full payload and no body."""
    import base64

    def name(i):
        return f"<urn:page:{'none' if i is None else i}>"

    body = b"" if refers_to is not None else payload
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)) + body
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's named fields, and ``payload`` and ``payload_bytes`` of its HTTP block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, fields["payload"] = block.partition(b"\r\n\r\n")
    said = re.search(rb"(?mi)^Content-Length: *([0-9]+)", http)
    fields["payload_bytes"] = int(said[1])
    return fields


def _page(name: str | None):
    said = name and name[len("<urn:page:"):-1]
    return None if said in (None, "none") else int(said)


def _written(folder: str):
    """Append the pages of a task to one file; yields the capture of each."""
    def run(batches):
        import uuid

        import pyarrow as pa

        fs, root = file_system(folder)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, digest, refers in zip(*b.columns):
                    page_id, url, payload, digest, refers = (x.as_py() for x in (page_id, url, payload, digest, refers))
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    z = zlib.compressobj(3, zlib.DEFLATED, 31)
                    data = z.compress(record(page_id, url, payload, digest, refers)) + z.flush()
                    out.write(data)
                    rows.append((url_key(url), page_id, name, at, len(data)))
                    at += len(data)
                cols = list(zip(*rows)) or [[]] * 5
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 ["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return run


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives under ``folder``; returns the captures."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= REVISIT_LEAST
    same = (rows.where(long).select("page_id", "digest").groupBy("digest")
            .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id"))
    same = materialize(same, "warc-same")
    if same.count() <= BROADCAST_ROWS:
        same = F.broadcast(same)
    rows = rows.join(same, "digest", "left")
    refers = F.when(long & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return materialize(rows.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
                       .mapInArrow(_written(folder), CAPTURE), "warc-captures")


def _indexed(folder: str, lines: int):
    """Compress the sorted captures of a task into the blocks of one index file; yields the directory."""
    def run(batches):
        import json
        import uuid

        import pyarrow as pa

        fs, root = file_system(folder)
        name, at, out, held = f"{uuid.uuid4().hex}.cdxz", 0, None, []

        def block():
            nonlocal at, out, held
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode("ascii"), 6)
            out.write(data)
            first, held = held[0], []
            at += len(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first[0]]), pa.array([first[1]], pa.int64()), pa.array([at - len(data)]),
                 pa.array([len(data)])], ["index_file", "key", "page_id", "offset", "length"])

        try:
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    held.append(row)
                    if len(held) == lines:
                        yield block()
            if held:
                yield block()
        finally:
            if out is not None:
                out.close()

    return run


def index(captures: DataFrame, folder: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures into index files of compressed blocks under ``folder``; returns the sparse directory."""
    by = [F.col("key"), F.col("page_id").asc_nulls_first()]
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))    # index files, and later tasks
    ordered = captures.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return materialize(ordered.mapInArrow(
        _indexed(folder, lines), "index_file string, key string, page_id long, offset long, length long"), "warc-directory")


def _rank(key: str, page_id) -> tuple:
    """The order of captures, as Spark sorts them: UTF-8 bytes of the key, then the page id, null first."""
    return key.encode("utf-8", "surrogatepass"), page_id is not None, page_id or 0


def _found(warc_folder: str, index_folder: str):
    """Look up one index file's share of the keys: directory, block, captures, records."""
    def run(key, wanted, directory):
        import base64
        import hashlib
        import json
        from bisect import bisect_left, bisect_right

        import pandas as pd

        columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        fs, root = file_system(warc_folder)
        index_fs, index_root = file_system(index_folder)
        entries = [(x[0], None if x[1] is None else int(x[1]), int(x[2]), int(x[3])) for x in zip(
            directory["key"], directory["page_id"], directory["offset"], directory["length"])]
        entries.sort(key=lambda x: _rank(*x[:2]))
        firsts = [_rank(*x[:2]) for x in entries]
        files, rows, loaded = {}, [], None

        def captures(n):
            nonlocal loaded
            if loaded is None or loaded[0] != n:
                _, _, offset, length = entries[n]
                with index_fs.open_input_file(f"{index_root}/{key[0]}") as f:
                    text = zlib.decompress(f.read_at(length, offset)).decode("ascii")
                lines = [json.loads(x) for x in text.split("\n")]
                loaded = n, lines, [_rank(x[0], x[1]) for x in lines]
            return loaded[1:]

        keys = sorted({_rank(k, None if i is None else int(i)) for k, i in zip(wanted["key"], wanted["page_id"])})
        for at in keys:
            n = max(0, bisect_left(firsts, at) - 1)      # equal captures may begin in the block before
            while n < len(entries) and firsts[n] <= at:
                lines, ranks = captures(n)
                for _, _, name, offset, length in lines[bisect_left(ranks, at):bisect_right(ranks, at)]:
                    if name not in files:
                        if len(files) >= 64:
                            files.pop(next(iter(files))).close()
                        files[name] = fs.open_input_file(f"{root}/{name}")
                    got = parse(zlib.decompress(files[name].read_at(length, offset), 31))
                    digest = base64.b32decode(got["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if got["WARC-Type"] == "response" and (hashlib.sha1(got["payload"]).hexdigest() != digest
                                                           or len(got["payload"]) != got["payload_bytes"]):
                        raise ValueError(f"damaged record in {name} at {offset}")
                    rows.append((_page(got["WARC-Record-ID"]), got.get("WARC-Target-URI"), got["payload_bytes"], digest,
                                 got["WARC-Type"], _page(got.get("WARC-Refers-To"))))
                n += 1
        for f in files.values():
            f.close()
        return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    return run


def _keyed(columns: str):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([url_key(x.as_py()) for x in b.column(0)], pa.string()), b.column(1)], ["key", "page_id"])

    return run


TASK_BYTES = 32 << 20      # of compressed records that one task reads back, about


def lookup(wanted: DataFrame, directory: DataFrame, warc_folder: str, index_folder: str, tasks: int | None = None) -> DataFrame:
    """Records of the captures with the ``(url, page_id)`` of ``wanted``: one row for each capture.

    The keys of an index file are dealt over as many groups as give ``tasks`` in all (by default the parallelism of
    the session): what is shuffled is keys, what a task costs is the records that it reads.
    """
    from bisect import bisect_right

    # one row for each index file: as many as the index was written in partitions
    firsts = sorted((_rank(r.k.key, r.k.page_id), r.index_file) for r in directory.groupBy("index_file").agg(
        F.min(F.struct("key", "page_id")).alias("k")).collect())
    shared = wanted.sparkSession.sparkContext.broadcast(([x for x, _ in firsts], [x for _, x in firsts]))

    def route(batches):
        import pyarrow as pa

        starts, files = shared.value
        for b in batches:
            rows = [(x, i, files[max(0, bisect_right(starts, _rank(x, i)) - 1)])
                    for x, i in zip(*(c.to_pylist() for c in b.columns)) if files]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int64(), pa.string()])],
                                             ["key", "page_id", "index_file"])

    keys = wanted.select("url", F.col("page_id").cast("long")).distinct().mapInArrow(
        _keyed("url"), "key string, page_id long")
    routed = keys.mapInArrow(route, "key string, page_id long, index_file string")
    # ids as text: pandas would turn them into floats beside nulls
    routed, directory = (x.withColumn("page_id", F.col("page_id").cast("string")) for x in (routed, directory))
    tasks = tasks or wanted.sparkSession.sparkContext.defaultParallelism
    slices = max(1, -(-tasks // max(1, len(firsts))))
    by = ["index_file", "slice"]
    # a number of partitions of its own, since the keys' bytes say nothing of the work
    routed = routed.withColumn("slice", F.pmod(F.xxhash64("key", "page_id"), F.lit(slices)).cast("int")).repartition(tasks, *by)
    directory = directory.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).repartition(tasks, *by)
    return routed.groupBy(*by).cogroup(directory.groupBy(*by)).applyInPandas(
        _found(warc_folder, index_folder), "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long")


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages, index the captures, and read every record back through the index."""
    folder = scratch_dir(spark, "warc")
    captures = write(pages, f"{folder}/archive")
    directory = index(captures, f"{folder}/index")
    stored = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-stored // TASK_BYTES))
    return lookup(pages, directory, f"{folder}/archive", f"{folder}/index", tasks)
