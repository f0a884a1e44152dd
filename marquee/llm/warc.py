"""WARC archives: write pages, resolve revisits by payload digest, write deduplicated archives.

Archives are gzip WARC/1.1 files of bounded size in a folder that all executors share, one gzip member
for each record. Only headers are shuffled: by payload digest to find each digest's original response,
then by archive to rewrite it. Payloads travel from the old archive to the new one within a task. Every
write goes to a fresh file name, and only names in the stored manifest count, so a task that is run
again leaves no double records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.shared import columns_of, file_system, map_rows, new_folder, remove_folder, stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Settings:
    least_bytes: int = 0  # payloads below this size are never made revisits
    file_bytes: int = 16 << 20  # compressed size at which an archive is closed
    file_records: int = 20_000
    level: int = 4  # of gzip


STEP = 8192  # bytes of an archive that are unpacked in one go
TASK_ARCHIVES = 16  # archives that a task reads or rewrites, one after the other, where there are many

MANIFEST = "archive string, records bigint, bytes bigint"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(kind: str, headers: dict[str, str], block: bytes, level: int) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return press.compress(raw) + press.flush()


def records_in(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive."""
    at = 0
    view = memoryview(data)
    while at < len(data):
        member, parts, end = zlib.decompressobj(31), [], at
        # In steps: what lies behind a member's end is copied, so the rest of the archive must not be fed.
        while not member.eof:
            if end >= len(data):
                raise ValueError(f"the record at {at} ends early")
            parts.append(member.decompress(view[end : end + STEP]))
            end = min(end + STEP, len(data))
        length = end - at - len(member.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield at, length, headers, rest[: int(headers["Content-Length"])]
        at += length


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


class Writer:
    """Writes records to archives of bounded size; ``manifest`` gets a row for each closed archive."""

    def __init__(self, folder: str, s: Settings):
        self.folder, self.s, self.manifest = folder, s, []
        self.parts: list[bytes] = []
        self.records = self.size = 0

    def add(self, kind: str, headers: dict[str, str], block: bytes) -> None:
        if not self.parts:
            info = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": _now(), "Content-Type": "application/warc-fields"}
            self._put(record("warcinfo", info, b"format: WARC File Format 1.1\r\n", self.s.level))
        self._put(record(kind, headers, block, self.s.level))
        self.records += 1
        if self.size >= self.s.file_bytes or self.records >= self.s.file_records:
            self.close()

    def _put(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)

    def close(self) -> None:
        if self.parts:
            name = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            files, path = file_system(name)
            files.create_dir(path.rpartition("/")[0])
            with files.open_output_stream(path, compression=None) as out:
                for part in self.parts:
                    out.write(part)
            self.manifest.append({"archive": name, "records": self.records, "bytes": self.size})
        self.parts, self.records, self.size = [], 0, 0

    def rows(self) -> dict[str, list]:
        out = {k: [m[k] for m in self.manifest] for k in ("archive", "records", "bytes")}
        self.manifest = []
        return out


def _read(name: str) -> bytes:
    files, path = file_system(name)
    with files.open_input_file(path) as source:
        return source.read()


def _http(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode("ascii") + payload


def write_pages(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write a response record for every row (page_id, url, html) and return the stored manifest.

    The payload is the html in UTF-8; a null html is an empty payload, a null url becomes
    ``urn:unknown``, a null page_id leaves the id header out.
    """
    narrow = columns_of(pages, page_id="page_id", url="url", html="html")

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        writer = Writer(folder, settings)
        for b in batches:
            for page, url, html in zip(b["page_id"], b["url"], b["html"], strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                writer.add("response", {
                    **_identity(
                        f"<urn:uuid:{uuid.uuid4()}>", _now(),
                        quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "urn:unknown", page,
                    ),
                    "Content-Type": "application/http;msgtype=response",
                    "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
                }, _http(payload))
            if writer.manifest:
                yield writer.rows()
        writer.close()
        yield writer.rows()

    return stored(map_rows(narrow, rows, MANIFEST), "manifest")


def _identity(record_id: str, date: str, url: str, page) -> dict[str, str]:
    own = {} if page is None else {"X-Page-Id": str(page)}
    return {"WARC-Record-ID": record_id, "WARC-Date": date, "WARC-Target-URI": url, **own}


def _record_id(archive: str, place: int) -> str:
    """Id of the rewritten record, from where it stood before: revisits can name it without a look-up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{place}')}>"


HEADERS = (
    "archive string, place bigint, kind string, page_id bigint, record_id string, url string, date string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint"
)


def read_headers(manifest: DataFrame) -> DataFrame:
    """The headers of all page records of the archives, each payload's size and digest taken anew.

    For a revisit they are those of the payload it stands for, as its header names them.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        names = [c.split()[0] for c in HEADERS.split(", ")]
        for b in batches:
            for archive in b["archive"]:
                out = []
                for place, _, h, block in records_in(_read(archive)):
                    kind = h["WARC-Type"]
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, digest = len(payload), digest_of(payload)
                        if h["WARC-Payload-Digest"] != f"sha1:{digest}":
                            raise ValueError(f"{archive} at {place}: the payload does not have its digest")
                    elif kind == "revisit":
                        size, digest = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
                    else:
                        continue
                    page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                    out.append((
                        archive, place, kind, page and int(page), h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Date"],
                        size, digest, refers and int(refers),
                    ))
                yield {n: [o[i] for o in out] for i, n in enumerate(names)}

    spread = manifest.select("archive").repartition(_tasks(manifest), "archive")
    return map_rows(spread, rows, HEADERS)


def _tasks(manifest: DataFrame) -> int:
    """Tasks to deal the archives to: a few for each core while there are few archives, and for any number of them
    at most ``TASK_ARCHIVES`` to a task on average, each at most file_bytes and one record."""
    archives = manifest.count()  # of a stored table: read from file footers
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    return max(1, min(archives, max(4 * cores, -(-archives // TASK_ARCHIVES))))


def resolve_revisits(manifest: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write the archives of ``manifest`` again to ``folder`` with equal payloads stored once.

    Of the responses with equal payloads of at least ``least_bytes`` bytes, that with the smallest page
    id (null last; then by place) stays a response, the others become revisits of it. All records get
    fresh headers (new ids, the date of the capture); revisits name the original's page, URI, date and digest. Returns the stored
    manifest of the new archives.
    """
    headers = stored(read_headers(manifest), "headers")
    order = F.struct(
        F.col("page_id").isNull().alias("none"), "page_id", "archive", "place", "url", "date"
    )
    # Headers by payload digest; combined before the shuffle, so a hot digest is no hot task.
    originals = stored(
        headers.where(F.col("payload_bytes") >= settings.least_bytes)
        .groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("o")).where("n > 1").drop("n"),
        "originals",
    )
    revisits = headers.where(F.col("payload_bytes") >= settings.least_bytes).join(originals, "payload_digest").where(
        (F.col("archive") != F.col("o.archive")) | (F.col("place") != F.col("o.place"))
    )
    # A row for each archive, also of those without revisits, and one for each revisit; a group is one
    # archive and so has at most file_records rows.
    none = F.lit(None)
    plan = manifest.select(
        "archive", F.lit(-1).cast("bigint").alias("place"), none.cast("string").alias("url"),
        none.cast("string").alias("date"), none.cast("bigint").alias("page"),
        none.cast("string").alias("home"), none.cast("bigint").alias("spot"),
    ).union(revisits.select("archive", "place", "o.url", "o.date", "o.page_id", "o.archive", "o.place"))

    def rewrite(table: pa.Table) -> pa.Table:
        refers = {r["place"]: r for r in table.to_pylist() if r["place"] >= 0}
        writer = Writer(folder, settings)
        archive = table["archive"][0].as_py()
        for place, _, h, block in records_in(_read(archive)):
            if h["WARC-Type"] != "response":
                continue
            payload = block.partition(b"\r\n\r\n")[2]
            new = _identity(_record_id(archive, place), h["WARC-Date"], h["WARC-Target-URI"], h.get("X-Page-Id"))
            new["WARC-Payload-Digest"] = h["WARC-Payload-Digest"]
            if place in refers:
                first = refers[place]
                new |= {
                    "WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(first["home"], first["spot"]),
                    "WARC-Refers-To-Target-URI": first["url"], "WARC-Refers-To-Date": first["date"],
                    "X-Payload-Length": str(len(payload)), "Content-Type": "application/http;msgtype=response",
                }
                if first["page"] is not None:
                    new["X-Refers-To-Page-Id"] = str(first["page"])
                writer.add("revisit", new, block[: len(block) - len(payload)])
            else:
                writer.add("response", new | {"Content-Type": "application/http;msgtype=response"}, block)
        writer.close()
        rows = writer.rows()
        return pa.table({
            "archive": pa.array(rows["archive"], pa.string()),
            "records": pa.array(rows["records"], pa.int64()),
            "bytes": pa.array(rows["bytes"], pa.int64()),
        })

    # By number, or Spark would merge the few bytes of all plans into one task that rewrites everything.
    dealt = plan.repartition(_tasks(manifest), "archive")
    return stored(dealt.groupBy("archive").applyInArrow(rewrite, MANIFEST), "manifest")


def archive_pages(pages: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> DataFrame:
    """Write the pages, resolve revisits and return the headers of the deduplicated archives.

    One row for each page row: page_id, payload_bytes, payload_digest, record_type, refers_to, archive.
    ``folder`` keeps the final archives (default: the session's shared folder). Repeated rows and repeated
    page ids get a record each; of equal payloads under the same smallest id, one is the response. A null
    page_id comes last; if all equal payloads have null ids, refers_to of the revisits is null. An empty
    table writes nothing and returns no rows.
    """
    spark: SparkSession = pages.sparkSession
    raw = new_folder(spark, "warc-raw")
    first = write_pages(pages, raw, settings)
    final = resolve_revisits(first, folder or new_folder(spark, "warc"), settings)
    remove_folder(raw)  # the deduplicated archives hold everything
    return read_headers(final).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to", "archive"
    )
