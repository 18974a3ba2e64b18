"""GenBank flat files: one row per CDS that has a protein id (survey id SRC-06)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "seqid string, type string, start bigint, end bigint, strand string, protein_id string, locus_tag string, product string, qualifiers map<string,string>, translation string"
_SPAN = re.compile(r"[<>]?(\d+)(?:\.\.[<>]?(\d+))?")
_QUALIFIER = re.compile(r'/([\w-]+)(?:=(?:"((?:[^"]|"")*)"|(\S+)))?', re.S)


def location(text: str) -> tuple[int, int, str] | None:
    """(start, end, strand) of a location: the span of its parts, complement being the - strand; ends in order."""
    spans = [(int(a), int(b or a)) for a, b in _SPAN.findall(re.sub(r"[A-Za-z_]\w*(\.\d+)?:", "", text))]
    if not spans:
        return None
    ends = [x for s in spans for x in s]
    return min(ends), max(ends), "-" if "complement" in text else "+"


def records(text: str) -> Iterator[tuple[str, str]]:
    """(version, feature table) of each record of a file."""
    for rec in re.split(r"^//\s*$", text, flags=re.M):
        if not rec.strip():
            continue
        version = re.search(r"^VERSION\s+(\S+)", rec, re.M) or re.search(r"^(?:ACCESSION|LOCUS)\s+(\S+)", rec, re.M)
        table = re.search(r"^FEATURES.*?\n(.*?)(?=^\S|\Z)", rec, re.M | re.S)
        yield version[1] if version else "", table[1] if table else ""


def features(table: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(type, location, qualifiers) of each feature."""
    for m in re.finditer(r"^ {5}(\S+)\s+(.*(?:\n {21}.*)*)", table, re.M):
        body = re.sub(r"\n {21}", "\n", m[2])
        place, _, rest = body.partition("\n/") if "\n/" in body else (body, "", "")
        found: dict[str, str] = {}
        for key, quoted, bare in _QUALIFIER.findall("/" + rest if rest else ""):
            value = re.sub(r"\s*\n\s*", "" if key == "translation" else " ", quoted).replace('""', '"') if quoted else bare
            found.setdefault(key, value)
        yield m[1], place.replace("\n", ""), found


def rows(text: str, wanted: str | None = None) -> Iterator[tuple]:
    """CDS rows of the record that is `wanted`, with or without its version, else of the first; of all records without
    `wanted`."""
    recs = list(records(text))
    if wanted:
        recs = [r for r in recs if wanted in (r[0], r[0].rsplit(".", 1)[0])][:1] or recs[:1]
    for version, table in recs:
        for kind, place, quals in features(table):
            at = location(place)
            if kind == "CDS" and "protein_id" in quals and at:
                yield version, kind, *at, quals["protein_id"], quals.get("locus_tag"), quals.get("product"), {k: v for k, v in quals.items() if k != "translation"}, quals.get("translation")


def read(spark: SparkSession, path: str, record: str | None = None) -> DataFrame:
    """A row per CDS with a protein id of the files of a path or glob, on any file system Spark reads; a file is one row of
    a task. record: see rows()."""
    arrow = pa.schema([("seqid", pa.string()), ("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), *[(c, pa.string()) for c in ("strand", "protein_id", "locus_tag", "product")], ("qualifiers", pa.map_(pa.string(), pa.string())), ("translation", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = list(rows(content.as_py().decode("utf-8", "replace"), record))
                cols = list(zip(*found, strict=True)) if found else [[]] * len(arrow)
                cols[8] = [list(q.items()) for q in cols[8]]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, SCHEMA)
