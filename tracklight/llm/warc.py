"""WARC archives: writing pages as records and reading records back from files cut anywhere.

Writing: a page becomes one ``response`` record with its HTTP block; of equal payloads of ``LEAST_REVISIT`` bytes or more
only the row with the largest page_id keeps the payload, the others become ``revisit`` records that name it. Spark's text
writer writes them, with the blank lines that end a record as its line separator, so a lost task is written anew.

Reading: Spark's text reader cuts the files at the magic, wherever a split begins. What follows a magic is a candidate:
its header says where its successor must begin. Magic words also occur inside payloads, so candidates are verified:

1. Tasks add up the lengths of a split and emit, for each candidate, its offset in the split and the first offset outside the
   split that its chain of successors leads to. Sums over the splits of a file turn these into offsets in the file.
2. Candidates that some chain leads to are nodes. Pointer jumping from offset 0 of each file doubles the chains until
   nothing new is reached: rounds grow with the logarithm of the splits of a file.
3. A second read walks each split from its reached offset. Pieces before it, and everything that lies inside a record, are put
   back into the record's payload; records whose payload goes on in the next split are put together by a shuffle of those
   records only.

Null html counts as empty, a null url leaves the target out, line ends in a url are percent-encoded. A null page_id is smaller
than any; rows that repeat the largest page_id of a group are all responses, and so is a group without any page_id. Empty
tables give no records. Columns other than the three named are not read. In files from elsewhere a chain ends at the first
offset without a record; a last record that the file cuts short is returned with ``whole`` false. A revisit takes the length of its
payload from its HTTP block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklight.llm.common import fits, give_back, hinted, slices
from tracklight.runtime import stage

# Fixed values of the format.
MAGIC, ENDS, BLANK = "WARC/1.", "\r\n\r\n", b"\r\n\r\n"
CUT = "\r\n" + MAGIC
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_REVISIT = 1000
RECORD = "file string, offset long, successor long, record_type string, record_id string, target_uri string, refers_to string, content_type string, declared_digest string, payload_digest string, payload_bytes long, whole boolean, payload binary"
PIECE = RECORD + ", at long, piece binary"


def records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(record): the text of a record for each row of (page_id, url, html), without the blank lines that end it."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("length", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    groups = rows.where(F.col("length") >= LEAST_REVISIT).groupBy(F.col("digest").alias("shared"), F.col("length").alias("shared_length"))
    groups = stage(groups.agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1 and keep is not null"), "warc-groups")
    same = (F.col("digest") == F.col("shared")) & (F.col("length") == F.col("shared_length"))
    rows = rows.join(hinted(groups, fits(groups, 96)), same, "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("length").cast("string")), F.lit("\r\n"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("length"))
    head = F.concat(
        F.lit(f"{MAGIC}1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(date)),
        F.when(uri.isNull(), "").otherwise(line("WARC-Target-URI", uri)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name("keep")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes one archive for each partition of the pages to the folder ``path``."""
    records(pages).write.option("lineSep", ENDS).text(path)


def _cut(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the bytes between two magics, in their order within a split."""
    lines = spark.read.option("lineSep", CUT).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))


def header(value: bytes, length: int) -> tuple[dict[bytes, bytes], int] | None:
    """Fields of the header that follows a magic and the number of bytes up to the block; None if it is no header.

    ``value`` holds the header at least; ``length`` is that of all that lies before the next magic. Where the block itself
    starts with a magic, the last line end of the header belongs to that cut.
    """
    if not re.match(rb"\d\r\n", value):
        return None
    end = value.find(BLANK)
    if end >= 0:
        size = end + 4
    elif len(value) < length:
        end = size = len(value)
        size += 4
    elif value.endswith(b"\r\n"):
        end, size = len(value) - 2, len(value) + 2
    else:
        return None
    fields: dict[bytes, bytes] = {}
    last = b""
    for row in value[3:end].split(b"\r\n"):
        if row[:1] in (b" ", b"\t") and last:
            fields[last] += b" " + row.strip()
        else:
            key, colon, text = row.partition(b":")
            if colon:
                last = key.strip().lower()
                fields.setdefault(last, text.strip())
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return fields, size


def _candidates(cut: DataFrame) -> DataFrame:
    """(file, block, at, exit): each candidate's offset and where its chain leaves the split, both from the split's first row;
    a row without ``at`` gives in ``exit`` how many bytes the split's rows stand for."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, found, total = None, [], 0

        def closed() -> pa.RecordBatch:
            leaves: dict[int, int] = {}
            for at, after in reversed(found):
                leaves[at] = leaves.get(after, after)
            ats = [*(at for at, _ in found), None]
            exits = [*(leaves[at] for at, _ in found), total]
            return pa.RecordBatch.from_arrays(
                [pa.array([place[0]] * len(ats), pa.string()), pa.array([place[1]] * len(ats), pa.int64()), pa.array(ats, pa.int64()), pa.array(exits, pa.int64())], names
            )

        for batch in batches:
            for file, block, head, length in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != place:
                    if place:
                        yield closed()
                    place, found, total = (file, block), [], 0
                first = block == 0 and total == 0 and not found and head.startswith(MAGIC.encode())
                at = 0 if first else total - len(MAGIC)
                skipped = len(MAGIC) if first else 0
                parsed = header(head[skipped:], length - skipped)
                if parsed:
                    found.append((at, at + len(MAGIC) + parsed[1] + int(parsed[0][b"content-length"]) + 4))
                total += length + len(CUT)
            give_back()
        if place:
            yield closed()

    names = ["file", "block", "at", "exit"]
    narrow = cut.select("file", "block", F.substring_index("value", ENDS, 1).cast("binary").alias("head"), F.octet_length("value").alias("length"))
    return narrow.mapInArrow(tasks, "file string, block long, at long, exit long")


def verified_splits(candidates: DataFrame) -> tuple[DataFrame, int]:
    """Splits (file, block, base, entry, until) and how many of them hold rows of a record that began in an earlier split, or
    end a file amid a record.

    ``base`` is the offset in the file of the split's first row, ``entry`` that of its first reachable record (null if
    none begins in it), ``until`` the offset at which the record that holds the split's first rows ends.
    """
    from pyspark.sql import Window

    ahead = Window.partitionBy("file").orderBy("block")
    totals = candidates.where("at is null").select("file", "block", F.col("exit").alias("total"))
    bases = stage(totals.withColumn("base", F.coalesce(F.sum("total").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "warc-bases")
    placed = candidates.where("at is not null").join(hinted(bases, fits(bases, 128)), ["file", "block"])
    placed = stage(placed.select("file", "block", (F.col("at") + F.col("base")).alias("at"), (F.col("exit") + F.col("base")).alias("exit")), "warc-candidates")
    aims = placed.select("file", F.col("exit").alias("at")).distinct()
    starts = bases.select("file", F.lit(0).cast("long").alias("at")).distinct()
    nodes = stage(placed.join(aims.unionByName(starts).distinct(), ["file", "at"], "left_semi").select("file", "at", "exit"), "warc-nodes")
    jump = stage(nodes.join(nodes.select("file", F.col("at").alias("exit")), ["file", "exit"], "left_semi").select("file", "at", "exit"), "warc-jumps")
    reached, size = stage(starts, "warc-reached"), -1
    while (now := reached.count()) != size and not jump.isEmpty():
        size = now
        further = reached.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at"))
        reached = stage(reached.unionByName(further).distinct(), "warc-reached")
        doubled = jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.exit") == F.col("b.at")))
        jump = stage(doubled.select("a.file", "a.at", "b.exit"), "warc-jumps")
    entered = placed.join(reached, ["file", "at"], "left_semi")
    entries = entered.groupBy("file", "block").agg(F.min("at").alias("entry"))
    last = entered.groupBy("file").agg(F.max("exit").alias("last"))
    splits = bases.join(entries, ["file", "block"], "left").join(last, "file", "left")
    following = F.first("entry", ignorenulls=True).over(ahead.rowsBetween(0, Window.unboundedFollowing))
    # The last row of a file is not followed by the cut that its length counts.
    amid = F.lead("block").over(ahead).isNull() & (F.col("last") > F.col("base") + F.col("total") - len(CUT))
    until = F.coalesce(following, F.col("last"))
    parted = F.coalesce(amid, F.lit(False)) | F.coalesce((F.col("block") > 0) & (until > F.col("base")), F.lit(False))
    splits = stage(splits.select("file", "block", "base", "entry", until.alias("until"), parted.alias("parted")), "warc-splits")
    return splits.drop("parted"), splits.where("parted").count()


def _record(file: str, at: int, successor: int, text: bytes, with_payload: bool) -> dict | None:
    """The record whose bytes after the first magic are ``text``, up to its successor at most."""
    parsed = header(text, len(text))
    if parsed is None:
        return None
    fields, size = parsed
    length = int(fields[b"content-length"])
    block = memoryview(text)[size : size + length]
    whole = len(block) == length
    content, payload, declared = fields.get(b"content-type", b""), block, None
    if content.lower().startswith(b"application/http"):
        ends = text.find(BLANK, size, size + length)
        if ends >= 0:
            payload = block[ends + 4 - size :]
            said = re.search(rb"(?im)^content-length:\s*(\d+)", text[size:ends])
            declared = int(said[1]) if said else None
    kind = fields[b"warc-type"].decode(errors="replace").lower()
    told = fields.get(b"warc-payload-digest", b"").decode(errors="replace")
    get = lambda key: fields[key].decode(errors="replace") if key in fields else None
    absent = kind == "revisit"
    return {
        "file": file, "offset": at, "successor": successor, "record_type": kind, "record_id": get(b"warc-record-id"), "target_uri": get(b"warc-target-uri"),
        "refers_to": get(b"warc-refers-to"), "content_type": get(b"content-type"), "declared_digest": told or None,
        "payload_digest": told.partition(":")[2] if absent else hashlib.sha1(payload).hexdigest(),
        "payload_bytes": declared if absent else len(payload), "whole": whole, "payload": bytes(payload) if with_payload else None,
    }


def _walk(rows: DataFrame, with_payload: bool) -> DataFrame:
    """Records that lie whole in a split, and pieces (file, successor, at, piece) of the others."""
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]) for c in PIECE.split(", ")])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, at, expected, now = None, [], 0, None, None

        def close() -> None:
            """Ends the record that is open: whole ones are parsed, others leave a piece."""
            if now:
                begin, successor, parts = now
                text = b"".join(parts)
                if len(MAGIC) + len(text) >= successor - begin - 4:
                    out.append(_record(place[0], begin, successor, text, with_payload))
                else:
                    out.append({"file": place[0], "successor": successor, "at": begin, "piece": text})

        for whole in batches:
            for batch in slices(whole, "value", 4 << 20):
                for file, block, base, entry, until, value in zip(*(c.to_pylist() for c in batch.columns)):
                    if (file, block) != place:
                        close()
                        place, at, expected, now = (file, block), base, entry, None
                    first = block == 0 and at == 0 and value.startswith(MAGIC.encode())
                    begin = 0 if first else at - len(MAGIC)
                    at += len(value) + len(CUT)
                    value = value[len(MAGIC) :] if first else value
                    if begin == expected:
                        close()
                        fields, size = header(value, len(value))
                        expected = begin + len(MAGIC) + size + int(fields[b"content-length"]) + 4
                        now = begin, expected, [value]
                    elif now and begin < expected:
                        now[2].extend((CUT.encode(), value))
                    elif not now and until is not None and begin < until:
                        out.append({"file": file, "successor": until, "at": begin, "piece": CUT.encode() + value})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
            give_back()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select("file", "block", "base", "entry", "until", F.col("value").cast("binary").alias("value")).mapInArrow(tasks, PIECE)


def _assembled(pieces: DataFrame, with_payload: bool) -> DataFrame:
    """Records put together from the pieces of several splits; one record lies in a row."""
    parts = pieces.groupBy("file", "successor").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("parts"))
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]) for c in RECORD.split(", ")])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                file, successor, own = (c[0].as_py() for c in batch.slice(row, 1).columns)
                found = _record(file, own[0]["at"], successor, b"".join(p["piece"] for p in own), with_payload)
                yield pa.RecordBatch.from_pylist([found] if found else [], schema)
            give_back()

    return parts.mapInArrow(tasks, RECORD)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under ``path`` that a chain from the start of their file reaches.

    Columns: file, offset, successor, record_type, record_id, target_uri, refers_to, content_type, declared_digest (as the
    header has it), payload_digest (SHA-1 in hex of the payload read, for revisits as declared), payload_bytes, whole, payload
    (null unless asked for).
    """
    splits, parted = verified_splits(stage(_candidates(_cut(spark, path)), "warc-found"))
    small = fits(splits, 160)
    rows = _cut(spark, path).join(hinted(splits, small), ["file", "block"])
    if not small:
        rows = _located(spark, path).join(splits, ["file", "block"])
        rows = rows.repartition("file", "block").sortWithinPartitions("file", "block", "place")
    walked = _walk(rows, with_payload)
    names = [c.split()[0] for c in RECORD.split(", ")]
    found = walked.where("piece is null").select(*names)
    return found.unionByName(_assembled(walked.where("piece is not null"), with_payload)) if parted else found


def _located(spark: SparkSession, path: str) -> DataFrame:
    """The cut rows with ``place``, which keeps their order within a split through a shuffle."""
    return _cut(spark, path).withColumn("place", F.monotonically_increasing_id())


def page_records(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that ``write_archives`` wrote."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
