"""WARC archives of pages: written by Spark, read back by boundary chains (operator 11).

Writing. A record is one row of text, so Spark's own text writer stores it, with its commit
protocol: a lost task leaves nothing behind. Of rows with the same payload of ``least`` bytes or more the
one with the largest ``page_id`` is a response, the others are revisits that refer to it and hold
the HTTP head only. Payloads are grouped by SHA-256 and length, pre-aggregated under 64
salts, and the groups are joined back under the same salts, so a payload that a third
of the pages share is no hot key.

Reading. Archives are read through Spark's text source, cut at every line that begins with the record
magic; the pieces of one input split come in order. A task reads each piece that looks like a record
head, notes its offset and the offset of its successor (head + declared length + two line ends), and follows
successors as far as they lie in its split. What leaves the splits forms a small table of pointers, and
pointer jumping from the start of each file finds, in a number of rounds logarithmic in a file's splits, where the chain
enters them. Only records on that chain are kept: magic inside a payload, and whole archives inside
a payload, are off the chain. A record cut by such magic is put together from its pieces in a second scan.

Defined results: a null ``html`` is an empty payload; a null ``url`` has no target header, line ends in one are
percent-encoded; a null ``page_id`` is kept as null and never referred to (a group of such rows only has no
revisits); rows that repeat the largest page_id of their group are responses all; an empty table gives an empty result; other
columns are ignored. A file that does not begin with a record has no records; a chain ends at the
first successor that is no record, and a record that its file cuts short is left out.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsframe.llm.common import materialize, release

CRLF = "\r\n"
#: The line beginning at which archives are cut, in both versions of the format.
MAGIC = "WARC/1."
SALTS = 64
DATE = "1970-01-01T00:00:00Z"
# Fixed value: the profile of revisits with an identical payload, as the standard names it.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_of(record_id: str | Column) -> Column:
    """The page_id in a record id written here (null for others)."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def keepers(pages: DataFrame, least: int) -> DataFrame:
    """(sha, bytes, salt, keeper): for payloads of several rows the largest page_id, under each salt that a row of them has."""
    part = pages.filter(F.col("bytes") >= least).groupBy("sha", "bytes", "salt").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("rows"))
    whole = part.groupBy("sha", "bytes").agg(F.max("top").alias("keeper"), F.sum("rows").alias("rows")).filter("rows > 1 AND keeper IS NOT NULL")
    return part.select("sha", "bytes", "salt").join(whole.select("sha", "bytes", "keeper"), ["sha", "bytes"])


def records_of(pages: DataFrame, least: int = 1000, date: str = DATE) -> DataFrame:
    """One column ``value``: the text of each page's record, without the two line ends behind it."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    src = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), html.alias("html")) \
        .withColumn("bytes", F.octet_length("html").cast("long")).withColumn("sha", F.sha2("html", 256)) \
        .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    shared = materialize(keepers(src, least), "warc-shared")
    rows = src.join(shared, ["sha", "bytes", "salt"], "left")
    again = F.coalesce(F.col("page_id") < F.col("keeper"), F.col("keeper").isNotNull())
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(F.col("again"), F.col("http")).otherwise(F.concat("http", "html"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = rows.withColumn("again", again).withColumn("http", http).withColumn("block", block)
    return rows.select(F.concat_ws(
        CRLF, F.lit(f"{MAGIC}1"), F.when(F.col("again"), F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url), F.when(F.col("again"), F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("keeper")))),
        F.when(F.col("again"), F.lit(f"WARC-Profile: {PROFILE}")), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.sha1("html")),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
        F.lit(""), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 1000, date: str = DATE) -> str:
    """Write one record per row of ``pages`` (page_id, url, html) as uncompressed archives in the folder ``path``."""
    records_of(pages, least, date).write.option("lineSep", CRLF * 2).option("compression", "none").text(path)
    return path


# -- reading ---------------------------------------------------------------

_HEAD = re.compile(rb"[01]\r\n")
FIELDS = "warc_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, intact boolean, payload binary"
PIECES = "file string, split long, at long, bytes long, cut long, succ long, leaves long, is_whole boolean, " + FIELDS
RECORDS = "file string, offset long, " + FIELDS
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(cols, kinds, strict=True)], names=list(names))


def _headers(head: bytes) -> dict[bytes, bytes]:
    """Header fields by lower-cased name; of a repeated one the first counts."""
    out: dict[bytes, bytes] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _parse_head(content: bytes) -> tuple[int, dict[bytes, bytes], int] | None:
    """Head length, fields and declared block length of what follows the magic, or None for no record."""
    if not _HEAD.match(content):
        return None
    end = content.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = _headers(content[:end])
    size = fields.get(b"content-length", b"")
    return (end + 4, fields, int(size)) if size.isdigit() and len(size) < 19 else None


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _record(fields: dict[bytes, bytes], block: bytes, payloads: bool) -> tuple:
    """The values of FIELDS of a record with its whole block."""
    kind = _text(fields.get(b"warc-type"))
    payload, full = block, len(block)
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        full = len(payload)
        if kind == "revisit":
            size = _headers(head).get(b"content-length", b"")
            full = int(size) if size.isdigit() else None
    said = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("ascii", "replace").lower()
    digest = said or None
    intact = None
    if kind != "revisit":
        digest = hashlib.sha1(payload).hexdigest()
        intact = digest == said if said else None
    return (kind, _text(fields.get(b"warc-record-id")), _text(fields.get(b"warc-target-uri")), _text(fields.get(b"warc-refers-to")),
            full, digest, intact, payload if payloads else None)


def _scan(payloads: bool):
    """Pieces of the splits of a task, in order, to rows of PIECES. Offsets count from the split's first piece;
    ``cut`` is where a candidate's magic begins (null: no candidate), ``leaves`` where its chain leaves the split."""
    nothing = (None,) * len(FIELDS.split(", "))

    def done(rows: list[list]):
        ends: dict[int, int] = {}
        for row in reversed(rows):
            if row[4] is not None:
                row[6] = ends[row[4]] = ends.get(row[5], row[5])
        return _batch([tuple(r) for r in rows], PIECES)

    def task(batches):
        rows: list[list] = []
        here, at = None, 0
        for batch in batches:
            for file, split, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if (file, split) != here:
                    if rows:
                        yield done(rows)
                    rows, here, at = [], (file, split), 0
                head = len(MAGIC) if split == 0 and at == 0 and value.startswith(MAGIC.encode()) else 0
                row = [file, split, at, len(value), None, None, None, None, *nothing]
                content = value[head:] if head else value
                found = _parse_head(content) if head or split or at else None
                if found:
                    size, fields, length = found
                    row[4] = at + head - len(MAGIC)
                    row[5] = at + head + size + length + 4
                    row[7] = size + length <= len(content)
                    if row[7]:
                        row[8:] = _record(fields, content[size: size + length], payloads)
                rows.append(row)
                at += len(value) + len(MAGIC) + 1
        if rows:
            yield done(rows)
    return task


def _values(batches):
    """(file, split, at, value) of all pieces, as ``_scan`` numbers them."""
    here, at = None, 0
    for batch in batches:
        rows = []
        for file, split, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (file, split) != here:
                here, at = (file, split), 0
            rows.append((file, split, at, value))
            at += len(value) + len(MAGIC) + 1
        yield _batch(rows, "file string, split long, at long, value binary")


def _mark(table: pa.Table) -> pa.Table:
    """One split's candidates (off, succ, entered): those that its entry reaches."""
    off, succ = table.column("off").to_pylist(), table.column("succ").to_pylist()
    on = {o for o, e in zip(off, table.column("entered").to_pylist(), strict=True) if e}
    for o, s in sorted(zip(off, succ, strict=True)):
        if o in on:
            on.add(s)
    return table.filter(pa.array([o in on for o in off], pa.bool_())).drop_columns(["entered"])


def _assemble(payloads: bool):
    def group(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        first = table.column("off")[0].as_py()
        content = f"\n{MAGIC}".encode().join(table.column("value").to_pylist())
        if first == 0:
            content = content[len(MAGIC):]
        size, fields, length = _parse_head(content)
        if len(content) < size + length:  # the file ends inside the record
            return pa.Table.from_batches([_batch([], RECORDS)])
        return pa.Table.from_batches([_batch([(table.column("file")[0].as_py(), first, *_record(fields, content[size: size + length], payloads))], RECORDS)])
    return group


def _jump(pointers: DataFrame) -> DataFrame:
    """(file, off) of the chain's entries: what the start of each file reaches over ``pointers`` (file, off, leaves)."""
    jumps = materialize(pointers, "warc-jumps")
    reached = materialize(jumps.filter("off = 0").select("file", "off"), "warc-reached")
    while not jumps.isEmpty():
        further = reached.join(jumps, ["file", "off"]).select("file", F.col("leaves").alias("off"))
        grown = materialize(reached.union(further).distinct(), "warc-reached")
        behind = jumps.select("file", F.col("off").alias("leaves"), F.col("leaves").alias("next"))
        doubled = materialize(jumps.join(behind, ["file", "leaves"]).select("file", "off", F.col("next").alias("leaves")), "warc-jumps")
        release(reached, jumps)
        reached, jumps = grown, doubled
    release(jumps)
    return reached


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives under ``path`` as RECORDS, in no order; ``payload`` only on request."""
    cut = spark.read.option("lineSep", f"\n{MAGIC}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    pieces = materialize(cut.mapInArrow(_scan(payloads), PIECES), "warc-pieces")
    # a split begins where the pieces of those before it end
    spans = pieces.groupBy("file", "split").agg(F.sum(F.col("bytes") + len(MAGIC) + 1).alias("span"))
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(spans.select("file", "split", F.coalesce(F.sum("span").over(order), F.lit(0)).alias("base")), "warc-bases")
    placed = pieces.join(bases, ["file", "split"])
    links = placed.filter("cut IS NOT NULL").select(
        "file", "split", (F.col("base") + F.col("cut")).alias("off"), (F.col("base") + F.col("succ")).alias("succ"),
        (F.col("base") + F.col("leaves")).alias("leaves"), "is_whole")
    links = materialize(links, "warc-links")
    entries = links.select("file", F.col("leaves").alias("off")).distinct()
    pointers = links.join(entries, ["file", "off"], "left_semi").union(links.filter("off = 0")).select("file", "off", "leaves").distinct()
    reached = _jump(pointers)
    marked = links.join(reached.withColumn("entered", F.lit(True)), ["file", "off"], "left") \
        .select("file", "split", "off", "succ", "is_whole", F.coalesce("entered", F.lit(False)).alias("entered"))
    chain = materialize(marked.groupBy("file", "split").applyInArrow(_mark, "file string, split long, off long, succ long, is_whole boolean"), "warc-chain")
    names = [f.split()[0] for f in FIELDS.split(", ")]
    out = placed.withColumn("offset", F.col("base") + F.col("cut")).join(
        chain.filter("is_whole").select("file", F.col("off").alias("offset")), ["file", "offset"]).select("file", "offset", *names)
    torn = chain.filter("NOT is_whole")
    if not torn.isEmpty():
        # the pieces of a torn record are those from its own to its successor's; a record lies in one file
        edges = chain.select("file", F.col("off").alias("pos"), "is_whole", F.lit(0).alias("is_piece"), F.lit(None).cast("long").alias("split"), F.lit(None).cast("long").alias("at"))
        some = placed.join(torn.select("file").distinct(), "file", "left_semi").select(
            "file", (F.col("base") + F.col("at")).alias("pos"), F.lit(None).cast("boolean").alias("is_whole"), F.lit(1).alias("is_piece"), "split", "at")
        upto = Window.partitionBy("file").orderBy("pos", "is_piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = F.last(F.when(F.col("is_piece") == 0, F.struct("pos", "is_whole")), ignorenulls=True).over(upto)
        wanted = materialize(edges.union(some).withColumn("record", last).filter("is_piece = 1 AND NOT record.is_whole").select(
            "file", "split", "at", F.col("pos").alias("start"), F.col("record.pos").alias("off")), "warc-torn")
        values = cut.mapInArrow(_values, "file string, split long, at long, value binary").join(wanted, ["file", "split", "at"])
        joined = values.select("file", "off", "start", "value").groupBy("file", "off").applyInArrow(_assemble(payloads), RECORDS)
        out = out.union(joined)
    return out
