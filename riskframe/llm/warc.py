"""WARC archives with revisit records, and capture histories by external merge.

Tasks write archives of one gzip member per record and, beside each archive, a run: its captures
sorted by URL key and timestamp, in small compressed frames with a sparse index. Runs are merged by
loser trees of at most ``FAN_IN`` runs: as long as there are more, groups of runs are merged into
longer ones, a task per group; the last merge is cut into ranges of the key, a task per range, which
seeks to its range in every run. The result is globally ordered. Nothing is sorted beyond one archive,
and a task holds one frame per run. Only files named by the tables of finished attempts are read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import attempt_name, opened, shared_folder
from riskframe.session import materialise, shuffle_width

#: Payloads from this size on are stored once.
LEAST_BYTES = 100
#: An archive ends after so many compressed bytes or records; runs per merge; captures per frame.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 100_000
FAN_IN, FRAME = 64, 512
NO_ID = -(1 << 63)


# -- records -------------------------------------------------------------------------------------


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, seconds: int, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to`` set) has an empty payload."""
    kind = "response" if refers_to is None else "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    date = datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append(f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record, with ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, fields["payload"] = block.partition(b"\r\n\r\n")
    fields["size"] = int(http.rpartition(b"Content-Length: ")[2])
    return fields


def _page(urn: str | None) -> int | None:
    number = urn[10:-1] if urn else "none"
    return None if number == "none" else int(number)


def members(file):
    """(offset, length, data) of every gzip member of an open archive, in order."""
    at, left = 0, b""
    while True:
        data, inflate, size = [], zlib.decompressobj(31), 0
        while not inflate.eof:
            part = left or file.read(1 << 20)
            if not part:
                if data or size:
                    raise ValueError("the archive is cut short")
                return
            data.append(inflate.decompress(part))
            left = inflate.unused_data
            size += len(part) - len(left)
        yield at, size, b"".join(data)
        at += size


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the last to the first, then path and query."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].partition("#")[0]
    return ",".join(reversed(host.split("."))) + ")" + (path or "/")


# -- sorted runs ---------------------------------------------------------------------------------


class RunWriter:
    """Captures in ascending order; returns (captures, keys spread evenly) on close."""

    def __init__(self, path: str):
        system, inside = opened(path)
        self.out, self.at, self.n = system.open_output_stream(inside), 0, 0
        self.frame, self.index = [], []

    def add(self, capture: list) -> None:
        self.frame.append(capture)
        self.n += 1
        if len(self.frame) == FRAME:
            self._flush()

    def _flush(self) -> None:
        data = zlib.compress("\n".join(map(json.dumps, self.frame)).encode(), 1)
        self.index.append((self.frame[0], self.at, len(data)))
        self.at += self.out.write(data)
        self.frame = []

    def close(self) -> tuple[int, list[str]]:
        if self.frame:
            self._flush()
        footer = zlib.compress(json.dumps(self.index).encode())
        self.out.write(footer + struct.pack("<Q", len(footer)))
        self.out.close()
        step = max(1, len(self.index) // 16)
        return self.n, [json.dumps(key) for key, _, _ in self.index[::step]]


def run_captures(path: str, low: list | None = None, high: list | None = None):
    """Captures c of a run with low <= c < high, read from the frame that may hold ``low``."""
    system, inside = opened(path)
    with system.open_input_file(inside) as file:
        size = file.size()
        (length,) = struct.unpack("<Q", file.read_at(8, size - 8))
        index = json.loads(zlib.decompress(file.read_at(length, size - 8 - length)))
        start = max(0, bisect.bisect_right([k for k, _, _ in index], low) - 1) if low is not None else 0
        for first, at, n in index[start:]:
            if high is not None and first >= high:
                return
            for line in zlib.decompress(file.read_at(n, at)).decode().split("\n"):
                capture = json.loads(line)
                if (low is None or capture >= low) and (high is None or capture < high):
                    yield capture


class LoserTree:
    """Merges sorted iterators: inner nodes keep the loser of their match, the root the winner."""

    def __init__(self, streams: list):
        self.streams, k = streams, len(streams)
        self.heads = [next(s, None) for s in streams]
        self.nodes = [-1] * max(k, 1)
        for i in range(k):
            self._play(i, building=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x < y)

    def _play(self, winner: int, building: bool = False) -> None:
        node = (winner + len(self.streams)) // 2
        while node:
            other = self.nodes[node]
            if building and other < 0:
                self.nodes[node] = winner
                return
            if self._before(other, winner):
                self.nodes[node], winner = winner, other
            node //= 2
        self.nodes[0] = winner

    def __iter__(self):
        while self.streams and self.heads[self.nodes[0]] is not None:
            winner = self.nodes[0]
            yield self.heads[winner]
            self.heads[winner] = next(self.streams[winner], None)
            self._play(winner)


# -- Spark jobs ----------------------------------------------------------------------------------

ARCHIVES = "archive string, run string, n long, keys array<string>"


def _archives_schema():
    return pa.schema([("archive", pa.string()), ("run", pa.string()), ("n", pa.int64()), ("keys", pa.list_(pa.string()))])


class _ArchiveWriter:
    def __init__(self, folder: str, name: str):
        self.path, self.run = f"{folder}/{name}.warc.gz", f"{folder}/{name}.run"
        system, inside = opened(self.path)
        self.out, self.at, self.captures = system.open_output_stream(inside, compression=None), 0, []

    def add(self, page_id, url, seconds, payload, digest, size, refers_to) -> None:
        data = record(page_id, url, seconds, payload, digest, size, refers_to)
        deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = deflate.compress(data) + deflate.flush()
        stamp = datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y%m%d%H%M%S")
        number = NO_ID if page_id is None else page_id
        self.captures.append([url_key(url), stamp, number, self.path, self.at, len(packed), digest, "response" if refers_to is None else "revisit"])
        self.at += self.out.write(packed)

    @property
    def full(self) -> bool:
        return self.at >= ARCHIVE_BYTES or len(self.captures) >= ARCHIVE_RECORDS

    def close(self):
        self.out.close()
        run = RunWriter(self.run)
        for capture in sorted(self.captures):
            run.add(capture)
        n, keys = run.close()
        return pa.RecordBatch.from_pylist([{"archive": self.path, "run": self.run, "n": n, "keys": keys}], schema=_archives_schema())


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", seconds: Column | None = None) -> DataFrame:
    """Archives of all pages; returns the table of archives and their runs.

    Of pages with equal payloads of at least ``LEAST_BYTES``, that with the smallest key is the
    response and others are revisits of it; repeated rows of that page are responses again, and
    where no such page has a key all are responses. A missing html is an empty payload, a missing
    url is left out of the record. ``seconds`` is the capture time since 1970, at most year 9999.
    """
    seconds = F.lit(0) if seconds is None else seconds
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(seconds.cast("long"), F.lit(0)).alias("seconds"),
        payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
    )
    firsts = materialise(
        rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first IS NOT NULL").select("digest", "first"),
        "first-captures",
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= LEAST_BYTES)
    planned = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "seconds", "digest", "size",
        F.when(again, F.col("first")).alias("refers_to"), F.when(~again, F.col("payload")).otherwise("").alias("payload"),
    )

    def write(batches):
        out, number = None, 0
        for b in batches:
            columns = [b[c].to_pylist() for c in ("page_id", "url", "seconds", "payload", "digest", "size", "refers_to")]
            for page_id, address, at, text, digest, size, refers_to in zip(*columns):
                if out is None:
                    out, number = _ArchiveWriter(folder, f"{attempt_name('pages')}-{number:04d}"), number + 1
                out.add(page_id, address, at, text.encode("utf-8", "surrogatepass"), digest, size, refers_to)
                if out.full:
                    yield out.close()
                    out = None
        if out is not None:
            yield out.close()

    return materialise(planned.mapInArrow(write, ARCHIVES), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record: page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset.

    Size and digest are those of the full payload: computed from it for responses, held by the
    record for revisits. A response whose digest isn't that of its payload is an error.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()),
    ])

    def row(path: str, at: int, data: bytes) -> dict:
        fields = parse(data)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind, size = fields["WARC-Type"], fields["size"]
        if kind == "response":
            size = len(fields["payload"])
            if hashlib.sha256(fields["payload"]).hexdigest() != digest:
                raise ValueError(f"{path}: wrong payload at {at}")
        return {
            "page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": _page(fields.get("WARC-Refers-To")), "archive": path, "offset": at,
        }

    def read(batches):
        for b in batches:
            for path in b[0].to_pylist():
                system, inside = opened(path)
                with system.open_input_stream(inside, compression=None) as file:
                    rows = []
                    for at, _, data in members(file):
                        rows.append(row(path, at, data))
                        if len(rows) == 1024:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    width = shuffle_width(archives.sparkSession)
    return archives.select("archive").repartition(width, "archive").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long"
    )


def merge_runs(runs: DataFrame, folder: str, fan_in: int = FAN_IN) -> DataFrame:
    """Merge all runs (run, n, keys) into globally ordered files: part int, path, n."""
    spark = runs.sparkSession
    system, inside = opened(folder)
    system.create_dir(inside, recursive=True)
    runs = runs.select("run", "n", "keys")
    merged = "run string, n long, keys array<string>"
    count = runs.count()
    while count > fan_in:
        def longer(batches):
            paths = sorted(p for b in batches for p in b["run"].to_pylist())
            for at in range(0, len(paths), fan_in):
                path = f"{folder}/{attempt_name('merged')}-{at}.run"
                out = RunWriter(path)
                for capture in LoserTree([run_captures(p) for p in paths[at : at + fan_in]]):
                    out.add(capture)
                n, keys = out.close()
                yield pa.RecordBatch.from_pylist([{"run": path, "n": n, "keys": keys}], schema=pa.schema(list(_archives_schema())[1:]))

        groups = -(-count // fan_in)
        dealt = runs.repartitionByRange(groups, "run") if groups > 1 else runs.coalesce(1)
        runs = materialise(dealt.mapInArrow(longer, merged), "merged-runs")
        previous, count = count, runs.count()
        if count >= previous:
            raise RuntimeError("runs can't be merged further")

    width = shuffle_width(spark)
    sampled = runs.select(F.explode("keys").alias("key")).orderBy(F.xxhash64("key"), "key").limit(20_000).collect()
    keys = sorted(json.loads(r["key"])[:3] for r in sampled)
    cuts = sorted({tuple(keys[i * len(keys) // width]) for i in range(1, width)}) if keys else []
    names = [r["run"] for r in runs.select("run").orderBy("run").collect()]  # at most fan_in

    def merge(batches):
        for b in batches:
            for part in b[0].to_pylist():
                low = list(cuts[part - 1]) if part else None
                high = list(cuts[part]) if part < len(cuts) else None
                path = f"{folder}/{attempt_name(f'captures-{part:06d}')}.run"
                out = RunWriter(path)
                for capture in LoserTree([run_captures(p, low, high) for p in names]):
                    out.add(capture)
                n, _ = out.close()
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "n": pa.array([n], pa.int64())})

    parts = spark.range(0, len(cuts) + 1, 1, len(cuts) + 1).select(F.col("id").cast("int"))
    return materialise(parts.mapInArrow(merge, "part int, path string, n long"), "capture-files")


def captures(files: DataFrame) -> DataFrame:
    """The ordered history: position (from 0), url_key, captured_at (14 digits), page_id, archive, offset, length."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("path", "begin")
    schema = pa.schema([
        ("position", pa.int64()), ("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()),
        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ])

    def rows(path: str, begin: int):
        for i, (key, stamp, number, archive, at, length, _, _) in enumerate(run_captures(path)):
            yield begin + i, key, stamp, None if number == NO_ID else number, archive, at, length

    def read(batches):
        for b in batches:
            for path, begin in zip(b[0].to_pylist(), b[1].to_pylist()):
                held = []
                for r in rows(path, begin):
                    held.append(dict(zip(schema.names, r)))
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return placed.repartition(shuffle_width(files.sparkSession), "path").mapInArrow(
        read, "position long, url_key string, captured_at string, page_id long, archive string, offset long, length long"
    )


def archive_pages(spark: SparkSession, pages: DataFrame, seconds: Column | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write archives, merge their runs, read all back: a row per page with its place in the history.

    Repeated rows have records of their own; an empty table writes nothing and gives no row.
    """
    folder = shared_folder(spark, "warc")
    archives = write_archives(pages, folder, key, url, html, seconds)
    history = captures(merge_runs(archives, f"{folder}/captures")).select("archive", "offset", "position", "url_key", "captured_at")
    # both sides are written: Spark would take the size of a task's output for that of its few file names
    history, records = materialise(history, "history"), materialise(read_archives(archives), "records")
    read = records.join(history, ["archive", "offset"])
    return read.withColumnRenamed("page_id", key)
