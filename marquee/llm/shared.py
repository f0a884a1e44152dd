"""What the operators share: intermediate tables in the shared folder, bounded Arrow batches, words."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marquee.session import ensure_checkpoint_dir

BATCH_ROWS = 500
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep an Arrow batch small, so that a run of very long texts does not fill a worker.

    Only makes the session's own limits smaller, never larger.
    """
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        value = spark.conf.get(key).lower().removesuffix("b")
        now = int(value) if value.lstrip("-").isdigit() else 0
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder all executors share (local mounts, S3, GCS, HDFS)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def remove_folder(uri: str) -> None:
    """Delete a folder that this library made."""
    files, path = file_system(uri)
    if files.get_file_info(path).type == pafs.FileType.Directory:
        files.delete_dir(path)


def _forget(uri: str) -> None:
    try:
        remove_folder(uri)
    except (OSError, pa.ArrowException):  # the folder may be gone with the session
        pass


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder, removed when the driver ends."""
    uri = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    atexit.register(_forget, uri)
    return uri


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, and it survives
    the loss of executors."""
    uri = new_folder(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def columns_of(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra columns cannot clash."""
    return df.select(*[df[theirs].alias(ours) for ours, theirs in names.items()])


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of a document table; a null text is an empty one."""
    pair = columns_of(docs, doc_id=id_col, text=text_col)
    return pair.withColumn("text", F.coalesce("text", F.lit("")))


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow over batches as dicts of Python lists, out as dicts of lists or arrays."""
    spark = df.sparkSession
    bounded_batches(spark)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = (dict(zip(names, (c.to_pylist() for c in b.columns), strict=True)) for b in batches)
        for out in rows(plain):
            yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(_typed(run, schema), schema)


def _typed(run, schema: str):
    """Cast what ``run`` yields to the Arrow types of the declared schema."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def typed(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name).cast(f.type) for f in target], schema=target
            )

    return typed


# Bytes of UTF-8 text: A-Z in lower case, 0-9, a-z and every byte of a non-ASCII letter stay,
# everything else becomes a space; bytes.split() then gives the words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_words(text: str) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def spaced_words(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()


def held_out(id_column) -> "F.Column":
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, most: int, chars: int) -> list[tuple]:
    """A bounded sample of labelled rows to learn from: [(text, label)].

    At most ``most`` rows of each label, those with the smallest hash of their id, among rows that
    are not held out and have between 1 and ``chars`` characters. So at most 2 x most x chars
    characters reach the driver, however many labels there are. Rows whose id has no label, a null
    label or contradicting labels are not used.
    """
    texts = texts_of(docs).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = columns_of(labels, doc_id="doc_id", label=target).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("_other")
    )
    known = known.where(F.col("label").isin(0, 1) & (F.col("label") == F.col("_other"))).drop("_other")
    sized = F.length("text").between(1, chars)
    rows = []
    for label in (0, 1):
        # Which ids first, without their texts: only the chosen ones are carried through a join.
        ids = (
            texts.where(sized).select("doc_id").distinct()
            .join(known.where(F.col("label") == label), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")
        )
        picked = (
            texts.where(sized).join(F.broadcast(ids), "doc_id")  # at most ``most`` ids
            .groupBy("doc_id").agg(F.min("text").alias("text"))
        )
        rows += [(r["doc_id"], r["text"], label) for r in picked.toLocalIterator()]
    rows.sort(key=lambda r: (str(r[0]), r[2]))  # one order on every cluster
    return [(text, label) for _, text, label in rows]
