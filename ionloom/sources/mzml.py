"""mzML files: spectra, index and single spectra.

Files go through Spark's text source with a spectrum's end tag as the record separator.  A record is one spectrum: the first
record of a file has the file's head in front of it, the last one is what follows the spectra.  So a large file is split by bytes
over many tasks, no task holds more than a few spectra, and a stream reads files the same way as a batch.  Elements without an end
tag of their own (``<spectrum .../>``) are passed over.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import re
import zlib
from collections.abc import Callable, Iterator
from xml.etree.ElementTree import Element, ParseError, fromstring
from xml.sax.saxutils import unescape

import numpy as np
import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

from ionloom.constants import SPECTRUM_SCHEMA
from ionloom.functions.naming import url_decoded

# Accessions of the PSI-MS vocabulary.
MS_LEVEL, SELECTED_MZ, CHARGE, POSSIBLE_CHARGE = "MS:1000511", "MS:1000744", "MS:1000041", "MS:1000633"
MZ_ARRAY, INTENSITY_ARRAY, ZLIB, FLOAT32 = "MS:1000514", "MS:1000515", "MS:1000574", "MS:1000521"

END = "</spectrum>"
_OPEN = re.compile(rb"<spectrum\s[^>]*(?<!/)>")
_ID = re.compile(rb"\sid=(?:\"([^\"]*)\"|'([^']*)')")
_HEAD = re.compile(r"<mzML\b.*?<spectrumList\b[^>]*>", re.S)
_PLAIN_HEAD = '<mzML xmlns="http://psi.hupo.org/ms/mzml" version="1.1.0"><run id="extract"><spectrumList count="1">'

#: Bytes of one Arrow batch of records, and spectra in one batch of rows.
BATCH_BYTES, BATCH_SPECTRA = 16 << 20, 200


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _terms(node) -> list[tuple[str, str]]:
    return [(x.get("accession"), x.get("value")) for x in node if _name(x.tag) == "cvParam"]


def _number(kind: type, value: str | None):
    """The value as a number, null if it is none."""
    try:
        return kind(value)
    except (TypeError, ValueError):
        return None


def _array(node) -> tuple[str | None, list[float]]:
    """Kind and values of a binary array; one that can't be decoded is empty."""
    terms = dict(_terms(node))
    data = next((x.text or "" for x in node if _name(x.tag) == "binary"), "")
    kind = MZ_ARRAY if MZ_ARRAY in terms else INTENSITY_ARRAY if INTENSITY_ARRAY in terms else None
    try:
        raw = base64.b64decode(data, validate=False)
        raw = zlib.decompress(raw) if ZLIB in terms and raw else raw
        return kind, np.frombuffer(raw, "<f4" if FLOAT32 in terms else "<f8").astype(float).tolist()
    except (ValueError, zlib.error):
        return kind, []


def _level(spectrum: bytes) -> int | None:
    """MS level of a spectrum element, null where it has none."""
    found = re.search(rb"<cvParam\b[^>]*\b" + MS_LEVEL.encode() + rb"\b[^>]*>", spectrum)
    value = found and re.search(rb"\bvalue=\"([^\"]*)\"", found[0])
    return _number(int, value[1].decode()) if value else None


def _element(record: bytes) -> tuple[int, str | None, bytes] | None:
    """Place, id and bytes (without the end tag) of the spectrum in a record; None in the record behind the last one."""
    opened = None
    for opened in _OPEN.finditer(record):
        pass
    if opened is None:
        return None
    name = _ID.search(opened[0])
    text = name and unescape((name[1] or name[2] or b"").decode("utf-8", "replace"), {"&quot;": '"', "&apos;": "'"})
    return opened.start(), text, record[opened.start() :]


def _parsed(spectrum: bytes) -> Element | None:
    try:
        return fromstring(spectrum.decode("utf-8", "replace") + END)
    except ParseError:
        return None


def _spectrum(record: bytes) -> dict | None:
    """A precursor without m/z has a null m/z, one without charge a null charge, also where the value is no number.

    A spectrum that is no XML (a file that ends early) keeps its id and level and has no peaks.
    """
    found = _element(record)
    if found is None:
        return None
    _, name, body = found
    node = _parsed(body)
    if node is None:
        return {"spectrum_id": name, "ms_level": _level(body), "mz": [], "intensity": [], "precursors": []}
    level = next((_number(int, v) for a, v in _terms(node) if a == MS_LEVEL), None)
    arrays, precursors = {}, []
    for x in node.iter():
        if _name(x.tag) == "binaryDataArray":
            kind, values = _array(x)
            arrays[kind] = values
        elif _name(x.tag) == "selectedIon":
            terms = _terms(x)
            mz = next((_number(float, v) for a, v in terms if a == SELECTED_MZ), None)
            charges = [_number(int, v) for want in (CHARGE, POSSIBLE_CHARGE) for a, v in terms if a == want]
            precursors += [{"mz": mz, "charge": z} for z in charges or [None]]
    return {"spectrum_id": name, "ms_level": level, "mz": arrays.get(MZ_ARRAY, []), "intensity": arrays.get(INTENSITY_ARRAY, []), "precursors": precursors}


def spectra_of(content: bytes) -> Iterator[dict]:
    """Spectra of one document in its order."""
    yield from filter(None, map(_spectrum, content.split(END.encode())))


def records(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """ms_run, path, block (first byte of the split) and the records of the files at ``path``, in file order within a split."""
    rows = reader.option("lineSep", END).text(path)
    run = F.regexp_replace(url_decoded(F.col("_metadata.file_name")), "(?i)\\.mzml(\\.gz)?$", "")
    return rows.select(run.alias("ms_run"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def spectra(rows: DataFrame, uuid: str) -> DataFrame:
    """Spectra of ``records`` under the search ``uuid``."""
    columns = [x.split()[0] for x in SPECTRUM_SCHEMA.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), BATCH_SPECTRA):
                some = part.iloc[at : at + BATCH_SPECTRA]
                found = [{"uuid": uuid, "ms_run": name, **s} for name, value in zip(some["ms_run"], some["value"], strict=True) if (s := _spectrum(value))]
                if found:
                    yield pd.DataFrame(found, columns=columns)

    return rows.select("ms_run", "value").mapInPandas(run, SPECTRUM_SCHEMA)


def read_spectra(spark: SparkSession, path: str, uuid: str) -> DataFrame:
    """Spectra of the mzML files at ``path`` (globs allowed) under the search ``uuid``."""
    _batches(spark)
    return spectra(records(spark.read, path), uuid)


def watch_spectra(spark: SparkSession, path: str, uuid: str, per_trigger: int = 10) -> DataFrame:
    """Spectra of mzML files as they arrive in a folder; ``per_trigger`` bounds the files of a batch."""
    _batches(spark)
    return spectra(records(spark.readStream.option("maxFilesPerTrigger", per_trigger), path), uuid)


def spectrum_index(spark: SparkSession, path: str, without_ms2: bool = False) -> DataFrame:
    """ms_run, spectrum_id and byte offset of every spectrum, or of those whose MS level isn't 2."""
    return spectrum_places(spark, path, without_ms2).select("ms_run", "spectrum_id", "offset")


def spectrum_places(spark: SparkSession, path: str, without_ms2: bool = False) -> DataFrame:
    """ms_run, path, spectrum_id, offset, length and head (bytes of the file before its first spectrum) of every spectrum.

    Offsets are counted in the unpacked file, after a byte order mark.  A record's offset is the bytes of all records before it; only
    its size, id and place enter the window over a file.
    """
    _batches(spark)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nr = 0
        for part in parts:
            out = []
            for name, file, block, value in zip(part["ms_run"], part["path"], part["block"], part["value"], strict=True):
                at, spectrum_id, body = _element(value) or (None, None, b"")
                out.append((name, file, block, nr, len(value) + len(END), at, spectrum_id, _level(body)))
                nr += 1
            yield pd.DataFrame(out, columns=["ms_run", "path", "block", "nr", "size", "at", "spectrum_id", "level"]).astype({"at": "Int64", "level": "Int32"})

    sizes = records(spark.read, path).mapInPandas(run, "ms_run string, path string, block long, nr long, size long, at long, spectrum_id string, level int")
    before = Window.partitionBy("path").orderBy("block", "nr").rowsBetween(Window.unboundedPreceding, -1)
    out = sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("at")).where("at is not null")
    out = out.withColumns({"length": F.col("size") - F.col("at"), "head": F.min("offset").over(Window.partitionBy("path"))}).where("spectrum_id is not null")
    return (out.where("level is null or level <> 2") if without_ms2 else out).select("ms_run", "path", "spectrum_id", "offset", "length", "head")


def write_places(places: DataFrame, path: str) -> None:
    """The index as Parquet, ordered by spectrum id, so that a lookup reads few row groups."""
    places.repartitionByRange("spectrum_id", "path").sortWithinPartitions("spectrum_id", "path").write.mode("overwrite").parquet(path)


class _Reader:
    """A file read at places; it counts the bytes that it takes from the file system.

    Paths are URIs as Spark's ``_metadata.file_path`` gives them and are opened by Arrow, so any store that Arrow knows will do.  A packed file
    is unpacked up to the place, as its offsets are those of the unpacked file; places come in ascending order, so it is unpacked once.
    """

    def __init__(self, path: str):
        system, name = FileSystem.from_uri(path)
        self.count, self.raw = 0, system.open_input_file(name)
        self.packed = gzip.GzipFile(fileobj=self) if name.lower().endswith(".gz") else None
        self.source = self.packed or self
        self.skip = 3 if self.take(0, 3) == codecs.BOM_UTF8 else 0

    def read(self, n: int = -1) -> bytes:
        out = self.raw.read(n if n >= 0 else None)
        self.count += len(out)
        return out

    def seek(self, at: int) -> None:
        self.raw.seek(at)

    def take(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def at(self, offset: int, n: int) -> bytes:
        return self.take(offset + self.skip, n)

    def close(self) -> None:
        self.raw.close()


def _placed(places: DataFrame, row: Callable[[_Reader, int, int, int], dict | None], schema: str) -> DataFrame:
    """``row`` of every place, in tasks that open a file once and read at its places only; ``bytes_read`` is what each place took."""
    columns = [x.split()[0] for x in schema.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, open_path = None, None
        for part in parts:
            for at in range(0, len(part), BATCH_SPECTRA):
                out = []
                some = part.iloc[at : at + BATCH_SPECTRA]
                for run_name, path, offset, length, head in zip(some["ms_run"], some["path"], some["offset"], some["length"], some["head"], strict=True):
                    if path != open_path:
                        if reader:
                            reader.close()
                        reader, open_path = _Reader(path), path
                    before, got = reader.count, row(reader, int(offset), int(length), int(head))
                    if got is not None:
                        out.append({"ms_run": run_name, **got, "bytes_read": reader.count - before})
                if out:
                    yield pd.DataFrame(out, columns=columns)
        if reader:
            reader.close()

    dealt = places.select("ms_run", "path", "offset", "length", "head").repartitionByRange("path", "offset").sortWithinPartitions("path", "offset")
    return dealt.mapInPandas(run, schema)


def read_places(places: DataFrame, uuid: str) -> DataFrame:
    """Spectra at the places of an index, and ``bytes_read``: only their bytes are read, whatever the files' size.

    Tasks are planned from the places, which are dealt by file and offset.  A place that holds no spectrum (the file has changed) gives no row.
    """

    def row(reader: _Reader, offset: int, length: int, head: int) -> dict | None:
        found = _spectrum(reader.at(offset, length).removesuffix(END.encode()))
        return found and {"uuid": uuid, **found}

    return _placed(places, row, SPECTRUM_SCHEMA + ", bytes_read long")


def extract_places(places: DataFrame) -> DataFrame:
    """ms_run, a standalone mzML document and ``bytes_read`` for each place: the file's head and the one spectrum are read."""

    def row(reader: _Reader, offset: int, length: int, head: int) -> dict | None:
        body = reader.at(offset, length).decode("utf-8", "replace")
        if _element(body.encode()) is None:
            return None
        start = _HEAD.search(reader.at(0, head).decode("utf-8", "replace"))
        start = re.sub(r'(<spectrumList\b[^>]*?\bcount=)"[^"]*"', r'\1"1"', start[0] if start else _PLAIN_HEAD)
        return {"mzml": f'<?xml version="1.0" encoding="utf-8"?>\n{start}{body}</spectrumList></run></mzML>\n'}

    return _placed(places, row, "ms_run string, mzml string, bytes_read long")


def index_json(index: DataFrame) -> DataFrame:
    """One JSON object of spectrum ids and offsets for each run."""
    return index.groupBy("ms_run").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("spectrum_id", "offset"))))).alias("index"))


def extract_spectrum(spark: SparkSession, path: str, spectrum_id: str) -> DataFrame:
    """ms_run and a standalone mzML document with the one spectrum under its file's head, for each file that has it."""
    _batches(spark)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, file, block, value in zip(part["ms_run"], part["path"], part["block"], part["value"], strict=True):
                head = _HEAD.search(value.decode("utf-8", "replace")) if b"<spectrumList" in value else None
                found = _element(value)
                body = found[2].decode("utf-8", "replace") + END if found and found[1] == spectrum_id else None
                if head or body:
                    out.append((name, file, block, head and head[0], body))
            yield pd.DataFrame(out, columns=["ms_run", "path", "block", "head", "body"]).astype({"block": "int64"})

    parts = records(spark.read, path).mapInPandas(run, "ms_run string, path string, block long, head string, body string")
    whole = parts.groupBy("path", "ms_run").agg(F.max("head").alias("head"), F.min_by("body", F.when(F.col("body").isNotNull(), F.struct("block", "body"))).alias("body"))
    head = F.regexp_replace(F.coalesce("head", F.lit(_PLAIN_HEAD)), '(<spectrumList\\b[^>]*?\\bcount=)"[^"]*"', '$1"1"')
    return whole.where("body is not null").select("ms_run", F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?>\n'), head, "body", F.lit("</spectrumList></run></mzML>\n")).alias("mzml"))
