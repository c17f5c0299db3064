"""WARC archives with a two-level capture index.

Writing: pages are shuffled once by page id and payload digest, so an id of
many rows is spread by its payloads; each task appends one gzip
member per record to an archive file of its own in the shared folder, and
returns where each record lies.  That manifest is written as a table, which
is the commit: files of failed attempts are never named in it.

Index: captures are sorted by key (reversed-host URL, capture number, payload
digest and copy),
and each range of keys becomes one index file of compressed blocks of
``lines`` captures, with a sparse directory beside it that holds each
block's first key and place.  The first level above is one (first key,
file) entry per index file, as many as there are ranges.

Reading: keys are looked up in sorted ranges; a look-up bisects the index
files' first keys, bisects that file's block directory, range-reads and
inflates the one block, bisects its lines, and range-reads the record from
the archive.

Among records with equal payloads of at least ``min_bytes`` bytes the one
with the largest page id is a response and the others are revisits of it
(WARC-Refers-To, no payload); all others are responses.

Defined results: null html is an empty payload; a null url gets the target
``urn:page:<id>``; white space and control characters in urls are
percent-encoded; a null page id counts as the smallest; of repeated rows
(page id and payload) one is the response and the others revisit it;
an empty table gives empty archives and no rows; columns other than page_id,
url and html are ignored.  Files are reached through
``pyarrow.fs`` by the scheme of the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.base import cut_lineage, scratch_path, shuffle_partitions

LINES = 1000
NO_ID = -(2**63)


def shared_file(uri: str):
    """(file system, path) of a URI, on the driver or an executor."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def surt(url: str) -> str:
    """Sort key of a URL: host labels reversed, then port and path:
    ``http://a.b.com:80/x?y`` -> ``com,b,a:80)/x?y``."""
    rest = url.split("://", 1)[1] if "://" in url else url
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    name, colon, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + colon + port + ")" + path


def clean_url(url: str | None, page) -> str:
    from urllib.parse import quote
    return f"urn:page:{page}" if url is None else quote(url, safe="".join(map(chr, range(33, 127))))


def base32_sha1(data: bytes) -> str:
    import base64
    import hashlib
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page, copy: int, url: str, payload: bytes, revisit_of=None) -> bytes:
    """One record, not yet compressed.  ``copy`` counts the records of this
    page and payload; copy 0 is the one that others refer to."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if revisit_of is None else 'revisit'}",
            f"WARC-Record-ID: <urn:capture:{page}:{digest}:{copy}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit_of is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:capture:{revisit_of}:{digest}:0>"]
        payload = b""
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict, bytes]:
    """Headers (lower-case names) and payload of an inflated record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    h = {k.lower(): v for k, v in h.items()}
    block = rest[:int(h["content-length"])]
    if len(block) != int(h["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("truncated record " + h["warc-record-id"])
    return h, block.partition(b"\r\n\r\n")[2]


MANIFEST = "page_id long, key string, file string, offset long, length long"


def _writer(root: str, min_bytes: int):
    """Rows (page_id, url, html, sha, of) sorted by page id and digest ->
    manifest rows.  ``of``: the page that has the response to this payload."""
    def run(batches):
        import gzip
        import uuid

        import pyarrow as pa
        name = f"{root}/archive-{uuid.uuid4().hex}.warc.gz"
        out, at, last, same = None, 0, None, 0
        for b in batches:
            rows = []
            for page, url, html, digest, of in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "of"))):
                if out is None:
                    fs, path = shared_file(name)
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                same = same + 1 if (page, digest) == last else 0
                last = page, digest
                payload = (html or "").encode()
                if of is None and len(payload) >= min_bytes and same:
                    of = NO_ID if page is None else page
                of = "null" if of == NO_ID else of
                target = clean_url(url, page)
                data = gzip.compress(record("null" if page is None else page, same, target, payload, of), 6, mtime=0)
                out.write(data)
                capture = (NO_ID if page is None else page) - NO_ID
                rows.append((page, f"{surt(target)} {capture:020d} {digest}:{same:010d}", name, at, len(data)))
                at += len(data)
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["page_id", "key", "file", "offset", "length"])
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, root: str, min_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) as archives under ``root``; returns the
    committed manifest (page_id, key, file, offset, length)."""
    pid = F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID))
    html = F.coalesce("html", F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.col("html").cast("string").alias("html"))
    hashes = (p.select(pid.alias("pid"), F.sha1(html).alias("sha"), F.octet_length(html).alias("n"))
              .filter(F.col("n") >= min_bytes).drop("n"))
    largest = (hashes.groupBy("sha").agg(F.max("pid").alias("of"), F.count("*").alias("c")).filter("c > 1")
               .select(F.col("sha").alias("s"), "of"))
    revisits = (hashes.distinct().join(largest, F.col("sha") == F.col("s")).filter("pid < of")
                .select(F.col("pid").alias("p"), "s", "of"))
    dealt = p.withColumn("pid", pid).withColumn("sha", F.sha1(html)).repartition("pid", "sha")
    rows = (dealt.join(revisits, (F.col("pid") == F.col("p")) & (F.col("sha") == F.col("s")), "left")
            .sortWithinPartitions("pid", "sha", "url").select("page_id", "url", "html", "sha", "of"))
    return cut_lineage(rows.mapInArrow(_writer(root, min_bytes), MANIFEST))


def _indexer(root: str, lines: int):
    """Sorted manifest rows -> an index file of compressed blocks, its
    directory file, and one row that names them."""
    def run(batches):
        import gzip
        import json
        import uuid

        import pyarrow as pa
        name = f"{root}/index-{uuid.uuid4().hex}.cdx.gz"
        out, at, total, first, block, directory = None, 0, 0, None, [], []

        def flush():
            nonlocal at, block
            data = gzip.compress("\n".join(block).encode(), 6, mtime=0)
            out.write(data)
            directory.append((" ".join(block[0].split(" ", 3)[:3]), at, len(data)))
            at += len(data)
            block = []

        for b in batches:
            for key, file, offset, length in zip(*(b.column(c).to_pylist() for c in ("key", "file", "offset", "length"))):
                if out is None:
                    fs, path = shared_file(name)
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out, first = fs.open_output_stream(path, compression=None), key
                block.append(f"{key} {json.dumps([file, offset, length])}")
                total += 1
                if len(block) == lines:
                    flush()
        if out is not None:
            if block:
                flush()
            out.close()
            fs, path = shared_file(name + ".dir")
            with fs.open_output_stream(path, compression=None) as d:
                d.write("\n".join(f"{k}\t{a}\t{n}" for k, a, n in directory).encode())
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name]), pa.array([total], pa.int64())],
                                             names=["first_key", "file", "captures"])
    return run


def write_index(manifest: DataFrame, root: str, lines: int = LINES, ranges: int | None = None) -> list[tuple[str, str]]:
    """Build the index; returns its first level, sorted: at most ``ranges``
    (first key, index file) pairs."""
    n = ranges or shuffle_partitions(manifest.sparkSession)
    level = cut_lineage(manifest.repartitionByRange(n, "key").sortWithinPartitions("key")
                        .mapInArrow(_indexer(root, lines), "first_key string, file string, captures long"))
    return sorted((r["first_key"], r["file"]) for r in level.collect())


FOUND = ("key string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _reader(level: list[tuple[str, str]]):
    """Sorted keys -> the records they lead to."""
    firsts = [k for k, _ in level]

    def run(batches):
        import gzip
        import json
        from bisect import bisect_left, bisect_right
        from collections import OrderedDict

        import pyarrow as pa
        handles, directories, held = OrderedDict(), OrderedDict(), (None, None)

        def fetch(file, offset, length):
            if file not in handles:
                fs, path = shared_file(file)
                handles[file] = fs.open_input_file(path)
                if len(handles) > 64:
                    handles.popitem(last=False)[1].close()
            handles.move_to_end(file)
            return handles[file].read_at(length, offset)

        def directory(file):
            if file not in directories:
                fs, path = shared_file(file + ".dir")
                with fs.open_input_stream(path, compression=None) as d:
                    rows = [x.rsplit("\t", 2) for x in d.read().decode().split("\n")]
                directories[file] = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
                if len(directories) > 4:
                    directories.popitem(last=False)
            return directories[file]

        def capture(key):
            nonlocal held
            file = level[max(0, bisect_right(firsts, key) - 1)][1]
            keys, places = directory(file)
            place = places[max(0, bisect_right(keys, key) - 1)]
            if held[0] != (file, place):
                held = (file, place), gzip.decompress(fetch(file, *place)).decode().split("\n")
            i = bisect_left(held[1], key + " ")
            if i == len(held[1]) or not held[1][i].startswith(key + " "):
                return None
            return json.loads(held[1][i][len(key) + 1:])

        def number(urn):
            page = urn.strip("<>").split(":")[2]
            return None if page == "null" else int(page)

        for b in batches:
            rows = []
            for key in b.column("key").to_pylist():
                place = capture(key)
                if place is None:
                    continue
                h, payload = parse(gzip.decompress(fetch(place[0], place[1], place[2])))
                said = h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-type"] == "response":
                    digest = base32_sha1(payload)
                    if digest != said:
                        raise ValueError("payload differs from its digest: " + h["warc-record-id"])
                    rows.append((key, number(h["warc-record-id"]), len(payload), digest, "response", None))
                else:
                    of = number(h["warc-refers-to"])
                    rows.append((key, number(h["warc-record-id"]), None, said, "revisit", of))
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["key", "page_id", "payload_bytes", "payload_digest",
                                                    "record_type", "refers_to"])
    return run


def look_up(keys: DataFrame, level: list[tuple[str, str]]) -> DataFrame:
    """Records of the captures named by ``keys`` (key); unknown keys give no
    row.  A revisit's payload size is that of the response it refers to."""
    schema = FOUND
    if not level:
        return keys.sparkSession.createDataFrame([], schema)
    n = shuffle_partitions(keys.sparkSession)
    found = cut_lineage(keys.select("key").repartitionByRange(n, "key").sortWithinPartitions("key")
                        .mapInArrow(_reader(level), schema))
    sizes = (found.filter("record_type = 'response'")
             .groupBy(F.col("page_id").alias("_of"), F.col("payload_digest").alias("_d"))
             .agg(F.max("payload_bytes").alias("_n")))
    return (found.join(sizes, F.col("refers_to").eqNullSafe(F.col("_of")) & (F.col("payload_digest") == F.col("_d")), "left")
            .select("key", "page_id", F.coalesce("payload_bytes", "_n").alias("payload_bytes"), "payload_digest",
                    "record_type", "refers_to"))


def archive_folder(spark) -> str:
    return scratch_path(spark, "warc")
