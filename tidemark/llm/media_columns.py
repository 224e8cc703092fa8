"""Interleaved document sequences with media columns.

HTML is parsed into an ordered array of elements: text, or a reference to media with its caption.
References name media by digest (`sha256:<hex>`); a join on the digest resolves them against a
media table that holds stored bytes, and the elements keep their positions, so captions stay with
their media. A caption belongs to the media of its figure, in front of them or behind; a figure
without media leaves it as text. An open `head` ends at the first element that can't stand in one.

Payloads are stored as PNG images of 8-bit grey samples, PIXELS wide (lossless, rows unfiltered),
in the `media` column of a table in the shared folder; a text block of the image holds the length
of the payload before padding. A task writes each digest once.

The query makes a page of every text, writes its image to the media table, parses the pages, joins
the digests that they name with the media table, reads the stored bytes back and measures them
there, once a digest, and joins the measures to the elements. The media table is dealt into folders
by digest, one for PER_FOLDER rows of the corpus, so that the distinct digests named of one folder
are that many at most (but for chance) and go to its stored bytes by a broadcast: payloads never
move, at any size. A folder with more than twice as many is joined by a shuffle. FOLDERS_AT_ONCE
folders are one job, so what is broadcast at once doesn't grow with the corpus. Digests named by
more than one in HOT_SHARE elements (no more than HOT_SHARE of them can be) meet their elements by a
broadcast in the second join, all others by a shuffle.

Null HTML or text: empty, which gives an empty sequence and a payload of one padded unit. A
reference that the media table lacks keeps its element with null media. Repeated rows come back as
often as they came. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, store
from .textkit import cut, documents, narrow, shared_dir

UNIT = 192
PIXELS = 192
HOT_SHARE = 10_000
PER_FOLDER = 250_000
FOLDERS_AT_ONCE = 4
_PNG = b"\x89PNG\r\n\x1a\n"

# Elements whose text is not shown, elements that end a run of text, elements of a head, media.
HIDDEN = {"script", "style", "noscript", "template"}
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "article", "section", "nav", "table", "tr", "td", "br", "hr", "figure", "figcaption", "blockquote", "pre", "header", "footer", "title"}
IN_HEAD = {"title", "meta", "link", "script", "style", "base", "noscript", "template", "head"}
MEDIA = {"img": "image", "audio": "audio", "video": "video", "source": "source", "embed": "embed"}


class _Sequence(HTMLParser):
    """Ordered elements: (position, kind, text, reference, caption)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements: list[tuple[int, str, str | None, str | None, str | None]] = []
        self.held: list[str] = []
        self.hidden = 0
        self.in_head = False
        self.figure: int | None = None
        self.in_caption = False
        self.caption: str | None = None  # of a figure without media so far

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if not text:
            return
        if self.in_caption and self.figure is not None:
            if not self.give_caption(text):
                self.caption = text
            return
        self.elements.append((len(self.elements), "text", text, None, None))

    def give_caption(self, text: str) -> bool:
        """Names the figure's media; False if it has none yet."""
        found = [i for i in range(self.figure, len(self.elements)) if self.elements[i][1] != "text"]
        for i in found:
            self.elements[i] = (*self.elements[i][:4], text)
        return bool(found)

    def end_figure(self) -> None:
        if self.caption is not None:
            self.elements.append((len(self.elements), "text", self.caption, None, None))
        self.figure = self.caption = None
        self.in_caption = False

    def handle_starttag(self, tag, attrs):
        if tag == "head":
            self.in_head = True
        elif tag not in IN_HEAD:
            self.in_head = False
        if tag in HIDDEN:
            self.hidden += 1
        if tag in BLOCKS:
            self.flush()
        if tag == "figure":
            self.end_figure()
            self.figure = len(self.elements)
        if tag == "figcaption":
            self.in_caption = True
        if tag in MEDIA and not self.hidden:
            self.flush()
            named = dict(attrs)
            self.elements.append((len(self.elements), MEDIA[tag], None, named.get("src"), self.caption or named.get("alt") or named.get("title")))
            self.caption = None if self.figure is not None else self.caption

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN:
            self.hidden -= 1

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if tag == "figcaption":
            self.in_caption = False
        if tag == "figure":
            self.end_figure()
        if tag == "head":
            self.in_head = False
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and not self.in_head:
            self.held.append(data)


def parse_html(html: str | None) -> list[tuple[int, str, str | None, str | None, str | None]]:
    parser = _Sequence()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    parser.end_figure()
    return parser.elements


ELEMENTS = "array<struct<position:int,kind:string,text:string,reference:string,caption:string>>"


def sequences(pages: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """id and its ordered elements."""
    rows = narrow(pages, id_col, html_col).toDF("id", "html")
    names = ("position", "kind", "text", "reference", "caption")
    kind = pa.list_(pa.struct([("position", pa.int32()), *((n, pa.string()) for n in names[1:])]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                parsed = [[dict(zip(names, e)) for e in parse_html(h)] for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(parsed, kind)], names=["id", "elements"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, elements {ELEMENTS}").withColumnRenamed("id", id_col)


def flat_elements(sequence: DataFrame, key: str) -> DataFrame:
    """One row per element, with the digest that it names."""
    flat = sequence.select(key, F.explode("elements").alias("e")).select(key, "e.*")
    return flat.withColumn("digest", F.when(F.col("reference").startswith("sha256:"), F.substring("reference", 8, 64)))


def with_media(flat: DataFrame, media: DataFrame) -> DataFrame:
    """The elements with the columns of `media` (a row a digest; null where it has no such digest).

    A digest of more than one in HOT_SHARE elements would fill a task: those, HOT_SHARE at most, are broadcast."""
    counts = flat.where("digest IS NOT NULL").groupBy("digest").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("count") * HOT_SHARE > total).select("digest"))
    named = flat.join(hot.withColumn("hot", F.lit(True)), "digest", "left")
    rare = named.where("hot IS NULL").drop("hot").join(media.join(hot, "digest", "left_anti"), "digest", "left")
    often = named.where("hot").drop("hot").join(F.broadcast(media.join(hot, "digest", "left_semi")), "digest", "left")
    return rare.unionByName(often)


def resolve(sequence: DataFrame, media: DataFrame, key: str) -> DataFrame:
    """One row per element in order, with the media table's columns; `media` has `digest` once per value."""
    return flat_elements(sequence, key).join(media, "digest", "left")


def store_png(payload: bytes, width: int = PIXELS, length: int | None = None) -> bytes:
    """PNG of 8-bit grey samples; the payload's length is a multiple of width. `length`: bytes before padding, as a text block."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, width)
    lines = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()

    def block(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    said = block(b"tEXt", b"Length\0%d" % length) if length is not None else b""
    return _PNG + block(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)) + said + block(b"IDAT", zlib.compress(lines)) + block(b"IEND", b"")


def png_blocks(stored: bytes):
    """(kind, body) of the blocks of a PNG, each held against its checksum."""
    if stored[:8] != _PNG:
        raise ValueError("not a PNG")
    at = 8
    while at < len(stored):
        size, kind = struct.unpack(">I4s", stored[at : at + 8])
        body = stored[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", stored[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged block")
        yield kind, body
        at += 12 + size


def read_png(stored: bytes) -> bytes:
    """The samples of a PNG written by store_png, row by row."""
    return read_image(stored)[0]


def read_image(stored: bytes) -> tuple[bytes, int | None]:
    """The samples, and the length before padding if the image names it."""
    width, height, length, packed = 0, 0, None, []
    for kind, body in png_blocks(stored):
        if kind == b"IHDR":
            width, height, depth, colour = struct.unpack(">IIBB", body[:10])
            if (depth, colour) != (8, 0):
                raise ValueError("not 8-bit grey samples")
        elif kind == b"tEXt" and body.startswith(b"Length\0"):
            length = int(body[7:])
        elif kind == b"IDAT":
            packed.append(body)
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes(), length


def padded(raw: bytes, unit: int = UNIT) -> bytes:
    return raw + b" " * (unit - len(raw) % unit if len(raw) % unit or not raw else 0)


def sample_features(samples: bytes) -> str:
    """Rows, mean and deviation of the samples, and a 64-bit mean-threshold fingerprint of 64 equal parts."""
    x = np.frombuffer(samples, dtype=np.uint8)
    parts = np.add.reduceat(x, np.arange(64) * len(x) // 64, dtype=np.int64) / np.diff(np.append(np.arange(64) * len(x) // 64, len(x)))
    bits = np.packbits(parts > x.mean()).tobytes().hex()
    return f"png;rows={len(x) // PIXELS};mean={x.mean():.4f};std={x.std():.4f};hash={bits}"


MEASURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def folder_of(digest, folders: int):
    """A digest's folder of the media table, from its first four bytes."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folders).cast("int")


def text_pages(docs: DataFrame, folders: int = 1) -> DataFrame:
    """doc_id and an HTML page that refers to the text's stored form by digest; digest, folder and media: that form, once a task."""
    rows = narrow(docs, "doc_id", "text")

    def run(batches):
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                pages, digests, places, media = [], [], [], []
                for text in part.column(1).to_pylist():
                    raw = (text or "").encode()
                    stored = store_png(padded(raw), length=len(raw))
                    name = hashlib.sha256(stored).digest()
                    digests.append(name.hex())
                    places.append(int.from_bytes(name[:4], "big") % folders)
                    pages.append(f'<article><h1>Text</h1><figure><img src="sha256:{name.hex()}"><figcaption>{len(raw)} bytes</figcaption></figure></article>')
                    media.append(None if name in seen else stored)
                    seen.add(name)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pages, pa.string()), pa.array(digests, pa.string()), pa.array(media, pa.binary()), pa.array(places, pa.int32())], names=["doc_id", "html", "digest", "media", "folder"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, html string, digest string, media binary, folder int")


def measured(media: DataFrame) -> DataFrame:
    """digest and the measures of the stored bytes (digest, media), read back."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["digest", *(m.split()[0] for m in MEASURES.split(", "))]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, out = batch.slice(at, 200), []
                for stored in part.column(1).to_pylist():
                    back, length = read_image(stored)
                    out.append((length, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), sample_features(back)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))], names=names)

    return media.select("digest", "media").mapInArrow(run, f"digest string, {MEASURES}")


def stored_media(spark, path: str, named: DataFrame):
    """Tables of digest and stored bytes of the named digests (distinct), FOLDERS_AT_ONCE folders each: the digests go to the bytes."""
    counts = {r["folder"]: r["count"] for r in named.groupBy("folder").count().collect()}  # a row a folder
    folders = sorted(counts)
    for first in range(0, len(folders), FOLDERS_AT_ONCE):
        out = None
        for folder in folders[first : first + FOLDERS_AT_ONCE]:
            media = spark.read.parquet(f"{path}/folder={folder}").where("media IS NOT NULL").select("digest", "media")
            wanted = named.where(F.col("folder") == folder).select("digest")
            found = media.join(F.broadcast(wanted) if counts[folder] <= 2 * PER_FOLDER else wanted, "digest", "left_semi")
            out = found if out is None else out.union(found)
        yield out


def op10_media_columns(spark, sf_dir):
    docs = documents(spark, sf_dir)
    folders = max(1, -(-docs.count() // PER_FOLDER))
    made_path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    pages = text_pages(docs, folders)
    pages.write.partitionBy("folder").parquet(made_path)
    made = spark.read.schema(pages.schema).parquet(made_path)
    elements, elements_path = store(flat_elements(sequences(made, "doc_id"), "doc_id").where("kind = 'image'").select("doc_id", "digest"))
    named = cut(elements.where("digest IS NOT NULL").select("digest").distinct().withColumn("folder", folder_of("digest", folders)))
    measures_path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    measures = measured(spark.createDataFrame([], "digest string, media binary"))
    measures.write.parquet(measures_path)
    for media in stored_media(spark, made_path, named):
        # A digest that several tasks stored is measured as often; one row stays.
        measured(media).dropDuplicates(["digest"]).write.mode("append").parquet(measures_path)
    measures = spark.read.schema(measures.schema).parquet(measures_path)
    out = cut(with_media(elements, measures).select("doc_id", *(m.split()[0] for m in MEASURES.split(", "))))
    for path in (made_path, elements_path, measures_path):
        drop(spark, path)
    return out
