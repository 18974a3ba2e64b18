"""Encodings and searches that need Python: download tokens, structures, JSON (survey ids SRC-17, SRC-22, STR-14, STR-15, JSN-01)."""

from __future__ import annotations

import base64
import json
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def varint(n: int) -> bytes:
    """Seven bits a byte, low first, the top bit set on all but the last."""
    if n < 0:
        raise ValueError("varints aren't negative")
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def field(number: int, value: int | bytes) -> bytes:
    """A numbered field: its varint tag, then a varint, or the length and the bytes."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def token(*fields: bytes) -> str:
    """URL-safe text of a message, deflated, without padding."""
    return base64.urlsafe_b64encode(zlib.compress(b"".join(fields), 9)).decode().rstrip("=")


# Address, methods, file server and names of the public download service (fixed values).
SERVICE = "https://api.ncbi.nlm.nih.gov/datasets/fetch_h"
REPORT_METHOD = "QXNzZW1ibHlEYXRhc2V0SW50ZXJuYWwuR2V0U2VxdWVuY2VSZXBvcnQ"
FILE_METHOD = "R2V0UmVtb3RlRGF0YWZpbGU"
SERVER = "https://ftp.ncbi.nlm.nih.gov/"
FILE_ENDS = {"gbff": "genomic.gbff.gz", "gff": "genomic.gff.gz", "fna": "genomic.fna.gz", "faa": "protein.faa.gz"}
REPORT = "sequence_report"


def report_url(accession: str) -> str:
    """Link to the sequence report of an assembly: its accession is field 1."""
    return f"{SERVICE}/{REPORT_METHOD}/{token(field(1, accession.encode()))}"


def file_url(folder: str, accession: str, kind: str) -> str | None:
    """Link to a file of an assembly: its address is field 1 of field 3, and fields 6 and 7 are set. folder is the
    assembly's address on the file server; null if it lies elsewhere."""
    if not folder.startswith(SERVER):
        return None
    inside = folder.removeprefix(SERVER).rstrip("/")
    last = inside.rsplit("/", 1)[-1]
    name = last.removeprefix(f"{accession}_")
    address = f"ncbi+ftp://{inside}/{accession}_{name}_{FILE_ENDS[kind]}"
    return f"{SERVICE}/{FILE_METHOD}/{token(field(3, field(1, address.encode())), field(6, 1), field(7, 1))}"


def link_table(assemblies: DataFrame, kinds: tuple[str, ...] = (*FILE_ENDS, REPORT), key: str = "assembly_id", folder: str = "ftp_path") -> DataFrame:
    """(key, filetype, url): a link per assembly and kind. Reports need the accession only; files need the folder, and an
    assembly whose folder is null, `na` or on another server has none. Blank accessions are left out, repeated rows
    count once."""
    unknown = [k for k in kinds if k != REPORT and k not in FILE_ENDS]
    if unknown:
        raise ValueError(f"unsupported filetype: {', '.join(unknown)}")

    @F.pandas_udf("string")
    def encode(ids: pd.Series, folders: pd.Series, types: pd.Series) -> pd.Series:
        return pd.Series([report_url(i) if k == REPORT else file_url(f, i, k) if f else None for i, f, k in zip(ids, folders, types, strict=True)])

    place = F.nullif(F.trim(F.col(folder)), F.lit("")) if folder in assemblies.columns else F.lit(None).cast("string")
    rows = assemblies.select(F.trim(F.col(key)).alias(key), F.when(F.lower(place) != "na", place).alias("_folder")).where(F.length(key) > 0).distinct()
    listed = rows.withColumn("filetype", F.explode(F.array(*[F.lit(k) for k in kinds])))
    return listed.select(key, "filetype", encode(key, "_folder", "filetype").alias("url")).where("url is not null")


def find_key(text: str | None, key: str) -> str | None:
    """The first value of a key anywhere in a JSON text, depth first; null if there is none or the text is no JSON."""
    try:
        stack = [json.loads(text or "")]
    except ValueError:
        return None
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if key in x:
                v = x[key]
                return v if isinstance(v, str) else json.dumps(v)
            stack.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            stack.extend(reversed(x))
    return None


def json_search(key: str):  # noqa: ANN201
    @F.pandas_udf("string")
    def search(s: pd.Series) -> pd.Series:
        return s.map(lambda t: find_key(t, key))

    return search


def pairs_from_model(text: str) -> str:
    """Dot-bracket structure of the consensus of a covariance model: a MATP node is a pair, MATL and MATR single
    positions; nodes stand in the order of the model, a bifurcation's left part before its right one."""
    nodes = re.findall(r"^\s*\[\s*(MATP|MATL|MATR|BIF|BEGL|BEGR|ROOT|END)\s+\d+\s*\]", text, re.M)

    at = 0

    def part() -> str:
        nonlocal at
        opened: list[tuple[str, str]] = []
        middle = ""
        while at < len(nodes):
            kind = nodes[at]
            at += 1
            if kind == "END":
                break
            if kind == "BIF":
                middle = part() + part()
                break
            opened.append({"MATP": ("(", ")"), "MATL": (".", ""), "MATR": ("", ".")}.get(kind, ("", "")))
        return "".join(a for a, _ in opened) + middle + "".join(b for _, b in reversed(opened))

    return part()


def slice_structure(structure: str, aligned: str, first: int) -> str:
    """The structure at the positions of a gapped alignment that begins at consensus position `first` (from 1); a pair
    whose partner lies outside, and inserts (lower case), are single positions; deleted positions (-) are left out."""
    stack, partner = [], {}
    for i, c in enumerate(structure):
        if c == "(":
            stack.append(i)
        elif c == ")" and stack:
            partner[i] = stack.pop()
            partner[partner[i]] = i
    at, kept = first - 1, []
    for c in aligned:
        if c.islower() or c == ".":
            kept.append(None)
        else:
            if c != "-":
                kept.append(at)
            at += 1
    inside = {k for k in kept if k is not None}
    return "".join(structure[k] if k is not None and k < len(structure) and partner.get(k) in inside else "." for k in kept)


@F.pandas_udf(T.StringType())
def structure_of(models: pd.Series) -> pd.Series:
    return models.map(lambda t: None if t is None else pairs_from_model(t))
