"""Test passages in training texts: Wu-Manber search for many patterns at once.

A pattern is a window of WORDS words in a row of a test text, or CHARS letters and digits in a row for languages written
without blanks. All windows have one length, so the search looks at the block of symbols that would end a window: the
shift table says how far the nearest window's end can be at least, and most positions of a text are never looked at. A
block that may end a window leads to the bucket of windows with this suffix, and these are compared in full.

Words are numbered by a vocabulary of the test texts, characters by their code points; all tables are arrays of numbers,
some 24 bytes a symbol. They hold the test texts only, are sent to the executors in parts of at most PART bytes and freed
when the texts have been searched; the texts are read once per part (a part holds about 10 million characters of test
texts, or 2 million of Chinese or Japanese).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.session import cut

#: Bytes of tables searched for in one pass, and bytes a character of test text takes in them: of words, and counted by itself.
PART = 64_000_000
PER_WORDS, PER_CHAR = 6, 28
WORDS, CHARS = 13, 20
#: Characters of text searched as one run.
AT_ONCE = 1_000_000
#: Languages counted in letters and digits (fixed values).
UNSPACED = ("zh", "ja")

_WORD = re.compile(r"[^\W_]+")
#: Invisible: format characters, variation selectors, fillers.
_UNSEEN = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0000-\U000e0fff]")


def words(text: str) -> list[str]:
    """Runs of letters and digits, in one case, in compatibility form, without invisible characters."""
    if text.isascii():
        return _WORD.findall(text.lower())
    text = unicodedata.normalize("NFKC", _UNSEEN.sub("", text)).casefold()
    return _WORD.findall(_UNSEEN.sub("", unicodedata.normalize("NFKC", text)))


class WuManber:
    """Windows of one length over numbered symbols, and the ids they stand for.

    shift[h] is how far the nearest window's end can be at least from a block of hash h; blocks of one hash share the
    smaller shift. Windows are sorted by the hash of their suffix block and carry that of their prefix block; what agrees
    in both is compared in full.
    """

    def __init__(self, length: int, block: int, texts: Sequence[tuple[int, np.ndarray]]) -> None:
        self.length, self.block = length, block
        texts = [(i, s) for i, s in texts if len(s) >= length]
        self.symbols = np.concatenate([s for _, s in texts]).astype(np.int32) if texts else np.zeros(0, np.int32)
        size = np.array([len(s) for _, s in texts], dtype=np.int64)
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(texts)), size)
        place = np.arange(len(self.symbols)) - first[of]
        bits = max(10, int(np.ceil(np.log2(4 * len(self.symbols) + 1))))
        self.mask = (1 << bits) - 1
        far = length - block + 1
        shift = np.full(1 << bits, min(far, 255), dtype=np.uint8)
        hashes = self.hashes(self.symbols)
        whole = np.nonzero(place >= block - 1)[0]  # blocks that lie in one text, by their last symbol
        np.minimum.at(shift, hashes[whole - block + 1] & self.mask, np.maximum(0, length - 1 - place[whole]).astype(np.uint8))
        self.shift = shift.tobytes()
        ends = np.nonzero(place >= length - 1)[0]
        suffix = hashes[ends - block + 1].astype(np.uint32)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.end = suffix[order], ends[order].astype(np.int32)
        self.prefix = hashes[self.end - length + 1].astype(np.uint32)
        self.ids = np.array([i for i, _ in texts], dtype=np.int64)[of[self.end]] if texts else np.zeros(0, np.int64)

    def __bool__(self) -> bool:
        return len(self.end) > 0

    def hashes(self, symbols: np.ndarray) -> np.ndarray:
        """The hash of the block that begins at each symbol."""
        n = len(symbols) - self.block + 1
        h = np.zeros(max(0, n), dtype=np.uint64)
        for k in range(self.block if n > 0 else 0):
            h = (h * np.uint64(FACTOR) + (symbols[k : k + n].astype(np.int64) + 1).astype(np.uint64)) & np.uint64(LOW)
        return (h ^ (h >> np.uint64(15))).astype(np.int64)

    def search(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, ids) of the windows found, in order of place; each window of an id once a place."""
        m, b, shift = self.length, self.block, self.shift
        last = len(symbols) - b
        if last < m - b or not self:
            return _NONE
        hashes = self.hashes(symbols)
        slots = (hashes & self.mask).tolist()
        at, maybe = m - b, []
        while at <= last:
            s = shift[slots[at]]
            if s:
                at += s
            else:
                maybe.append(at)
                at += 1
        if not maybe:
            return _NONE
        block = np.array(maybe)
        suffix = hashes[block].astype(np.uint32)
        lo, hi = (np.searchsorted(self.suffix, suffix, side) for side in ("left", "right"))
        n_each = hi - lo
        start = np.repeat(block + b - m, n_each)
        window = np.repeat(lo - np.cumsum(n_each) + n_each, n_each) + np.arange(n_each.sum())
        own = self.prefix[window] == hashes[start].astype(np.uint32)
        start, window = start[own], window[own]
        for k in range(m):
            own = self.symbols[self.end[window] - m + 1 + k] == symbols[start + k]
            start, window = start[own], window[own]
            if not len(start):
                return _NONE
        found = np.unique(np.stack([start, self.ids[window]], axis=1), axis=0)
        return found[:, 0], found[:, 1]


#: Constants of the block hash.
FACTOR, LOW = 0x9E3779B1, 0xFFFFFFFF
_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def code_points(found: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), dtype=np.int32)


class Tables:
    """The two automata for (id, lang, text): words, and characters for the languages in UNSPACED."""

    def __init__(self, items: Iterable[tuple[int, str | None, str | None]], n_words: int = WORDS, n_chars: int = CHARS) -> None:
        self.vocabulary: dict[str, int] = {}
        by_word, by_char = [], []
        for ident, lang, text in items:
            if text:
                found = words(text)
                if re.split(r"[-_]", (lang or "").strip().lower())[0] in UNSPACED:
                    by_char.append((ident, code_points(found)))
                else:
                    by_word.append((ident, np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found], dtype=np.int32)))
        self.by_word, self.by_char = WuManber(n_words, 2, by_word), WuManber(n_chars, 3, by_char)

    def search(self, texts: Sequence[str]) -> list[tuple[int, int, int, int]]:
        """(number of the text, id, first place, windows found) of each test text in the texts. They are searched as one
        run of symbols, with a symbol between them that no window holds."""
        found = [words(t) for t in texts]
        out: list[tuple[int, int, int, int]] = []
        if self.by_word:
            get = self.vocabulary.get
            symbols: list[int] = []
            starts = []
            for own in found:
                starts.append(len(symbols))
                symbols += [get(w, -1) for w in own]
                symbols.append(-1)
            out += _summed(np.array(starts), *self.by_word.search(np.array(symbols, dtype=np.int32)))
        if self.by_char:
            joined = ["".join(own) for own in found]
            size = np.array([len(x) + 1 for x in joined])
            out += _summed(np.cumsum(size) - size, *self.by_char.search(code_points("\0".join(joined))))
        return out


def _summed(starts: np.ndarray, places: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
    text = np.searchsorted(starts, places, "right") - 1
    which, first, n = np.unique(np.stack([text, ids], axis=1), axis=0, return_index=True, return_counts=True)
    return list(zip(which[:, 0].tolist(), which[:, 1].tolist(), (places - starts[text])[first].tolist(), n.tolist(), strict=True))


def _runs(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, texts) of the texts that aren't empty, some AT_ONCE characters at a time and whole texts always."""
    rows, held, size = [], [], 0
    for row, t in enumerate(texts):
        if t:
            rows.append(row)
            held.append(t)
            size += len(t)
            if size >= AT_ONCE:
                yield rows, held
                rows, held, size = [], [], 0
    if held:
        yield rows, held


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", lang: str = "lang", n_words: int = WORDS, n_chars: int = CHARS, part: int = PART) -> DataFrame:
    """(key, item, first_at, n_found): the documents that hold at least n_words words in a row of a test text (n_chars
    letters and digits for Chinese and Japanese), with the place of the first window, in words or characters, and the
    number of windows found.

    Texts are compared without case, compatibility forms, invisible characters and what stands between words. Null or
    shorter texts match nothing. Repeated rows of a document give repeated rows; other columns don't matter; an empty
    table on either side gives no rows. Whole documents are searched, row by row, without a shuffle.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item).cast("bigint").alias("i"), F.col(lang).alias("l"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    unspaced = F.split(F.lower(F.trim("l")), "[-_]")[0].isin(*UNSPACED)
    size = wanted.agg(F.sum(F.length("t") * F.when(unspaced, PER_CHAR).otherwise(PER_WORDS))).first()[0] or 0
    parts = -(-size // part) or 1
    kind = dict(docs.dtypes)[key]
    out = None
    for p in range(parts):
        rows = wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p) if parts > 1 else wanted
        held = spark.sparkContext.broadcast(Tables([tuple(r) for r in rows.collect()], n_words, n_chars))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                at, hits = [], []
                for rows_, texts in _runs(batch.column(1).to_pylist()):
                    for k, *hit in held.value.search(texts):
                        at.append(rows_[k])
                        hits.append(hit)
                ids, first, count = zip(*hits, strict=True) if hits else ((), (), ())
                yield pa.record_batch({"key": batch.column(0).take(pa.array(at, pa.int32())), "item": pa.array(ids, pa.int64()), "first_at": pa.array(first, pa.int32()), "n_found": pa.array(count, pa.int32())})

        one = docs.select(F.col(key).alias("key"), F.col(text).alias("t")).where("t is not null").mapInArrow(scan, f"key {kind}, item bigint, first_at int, n_found int")
        one = cut(one, "leaks")  # what was found is written, so the tables can go
        held.destroy()
        out = one if out is None else out.unionByName(one)
    return out.select(F.col("key").alias(key), F.col("item").alias(item), "first_at", "n_found")
