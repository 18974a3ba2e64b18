"""Several values packed in one field: EM learns from the whole column which values there are, a Viterbi lattice splits.

A field is cut into pieces at every run of possible delimiters outside quoted spans, which are atomic. A value is a span
of one or more pieces, inner delimiters included. Whether a delimiter parts values is not fixed: `|` does in one column
and is part of each value in another, and a comma may part the values of a list and belong to one frequent value in it.
What is learned, per column and key (`Dbxref`, none):

  theta[key, delimiter]   how often a value begins behind the delimiter
  begin[key, shape]       how often a value begins with a piece of this shape
  carry[key, shape]       how often a piece of this shape carries a value on
  freq[key, value]        how often a whole value occurs

A shape is the piece with its letters and digits made alike. The first piece of a field and any piece with a key of its
own begin a value for certain, which anchors `begin`; the other pieces are hidden and get their expected counts in each
round of EM. Values seen whole (quoted, or alone between two delimiters) and spans of several pieces are counted with the
delimiters around them; EM weighs each by how likely these part values and by its own lattice, so that a span counts as
far as it is one value rather than several.

An arc of the lattice is a whole value. Its weight is that of its frequency, if the column has it often enough, and of its
shapes otherwise, so it isn't the sum of weights of its pieces: a known value of three pieces stays one where each of its
delimiters, looked at alone, would part. Arcs of unknown values are worked off piece by piece, those of known ones are no
longer than the longest known one, so a field takes time in proportion to its pieces.

A field is parsed once and kept as pieces. All of the column is counted, every shape and value of each key that has an open
place anywhere, two pieces of which the second might carry the first on; the values of other keys are certain, and nothing
asks for their counts. Pieces are counted first; spans of
several pieces then by fours, each pass only where the spans of the pass before occur twice or more (a span can't recur
unless its parts do), as far as any recur. A filter of hashes tells the tasks where, which may let more through and never
less. What occurs once isn't known. Of what recurs all is, but for spans that save less
than it takes to spell them once, as two lists that happen to be alike do.

If the sums are few the driver has the model. If not, no place holds all of it: EM over shapes works on classes of shapes
with the same counts, key by key; EM over values on groups of spans, and the lattice on groups of records, to which a join
brings what their own pieces ask for. Both ways give the same values.
"""

from __future__ import annotations

import json
import marshal
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinage.session import cut, drop_table

#: Characters that may part values (fixed values); blanks around them belong to them.
DELIMITERS = ";|,\t\n\r"
FIRST, KEYED, LAST = "^", "=", "$"
#: Rounds of EM, and the size of a frequent-item summary.
ROUNDS, KEPT = 8, 16_384
#: Sums, and letters in them, of a model that the driver holds; records or spans of a group beyond.
LOCAL, LETTERS, GROUP = 200_000, 32_000_000, 20_000
#: Bits of a filter of hashes, and by how much spans get longer from pass to pass.
BITS, LONGER = 1 << 20, 4
#: Sums a task holds before it passes them on.
HELD = 100_000
#: Weight of a known value's frequency, and the cost of a letter of a value that isn't known.
KNOWN, LETTER = 0.5, math.log(50)

_STOPS = re.compile(r"[;,|\t\n\r]")
_BRACKET = re.compile(r"[\[\]]")
_QUOTED = {q: re.compile(rf"{q}(?:[^{q}]|{q}{q})*{q}(?=\s*(?:[;,|\t\n\r\]]|$))") for q in "\"'"}
#: Key, text as far as the next delimiter outside quotes (with blanks behind it), its quoted span and this delimiter, for fields
#: with keys and without.
_PIECE = {k: re.compile(rf"""\s*{open_key}((?:({'|'.join(q.pattern for q in _QUOTED.values())}))?[^;|,\t\n\r]*)([;|,\t\n\r]?)""") for k, open_key in ((True, r"""(?:([A-Za-z_][\w.:-]*)(?:\s*=\s*|\s+(?=["'])))?"""), (False, "()?"))}
_RUNS = re.compile(r"w(?:[ _.'/-]?[w9])*|9+| +")


class _Classes(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "w" if c.isalpha() else "9" if c.isdigit() else " " if c.isspace() else c
        return kind


_CLASSES = _Classes()
#: Shapes of texts whose letters and digits are made alike, as far as they have been worked out; few differ.
_SHAPES: dict[str, str] = {}


def shape(text: str) -> str:
    """Letters and digits made alike; words with what joins them are one w, other runs one sign. A long shape is told
    from others by its digest."""
    alike = text.translate(_CLASSES)
    known = _SHAPES.get(alike)
    if known is None:
        s = _RUNS.sub(lambda m: m[0][0], alike)
        known = s if len(s) <= 48 else blake2b(s.encode(), digest_size=16).hexdigest()
        if len(alike) <= 64 and len(_SHAPES) < HELD:
            _SHAPES[alike] = known
    return known


def pieces(field: str, keyed: bool) -> list[tuple[str, str | None, str, str, bool]]:
    """(delimiter before, key, text, gap, quoted) of each piece that isn't empty; gap: all between this text and the last."""
    body = field.strip()
    if body[:1] == "[" and body[-1:] == "]" and not _BRACKET.search(body[1:-1]):
        body = body[1:-1]
    out: list = []
    match, at, delimiter, done = _PIECE[keyed].match, 0, FIRST, 0
    while True:
        m = match(body, at)
        key, text, quoted, by = m.groups()
        text = text.rstrip()
        if text:
            start = m.start(2)
            out.append((delimiter, key or None, text, body[done:start] if out else "", quoted is not None))
            done, delimiter = start + len(text), ""
        if not by:
            return out
        if not delimiter or (delimiter != FIRST and DELIMITERS.find(by) < DELIMITERS.find(delimiter)):
            delimiter = by
        at = m.end()


def unquoted(text: str) -> str:
    """Without enclosing quotes, a doubled quote inside made single."""
    q = text[:1]
    if q in _QUOTED and len(text) > 1 and _QUOTED[q].fullmatch(text):
        return text[1:-1].replace(q + q, q).strip()
    return text


def _letters(text: str) -> float:
    return LETTER * len(text)


def shape_model(rows: list[tuple[dict[str, int], int]], rounds: int = ROUNDS) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """theta by delimiter, and begin and carry of each row, of one key by EM. rows: (n by delimiter, shapes that have these)."""
    # the weight of one made-up count keeps unseen shapes possible, and less likely to carry on than to begin
    floor_begin, floor_carry = 1e-4, 1e-5
    behind = sorted({d for r, _ in rows for d in r} - {FIRST, KEYED})
    own = np.array([[r.get(d, 0) for d in behind] for r, _ in rows], float).reshape(len(rows), len(behind))
    sure = np.array([r.get(FIRST, 0) + r.get(KEYED, 0) for r, _ in rows], float)
    like = np.array([m for _, m in rows], float)
    total = (like * sure).sum()
    theta = np.full(len(behind), 0.5)
    begin = np.maximum(sure / total if total else np.full(len(rows), 1 / like.sum()), floor_begin)
    carry = np.full(len(rows), 1 / 512)
    every, of_delimiter = own.sum(1), like @ own
    for _ in range(rounds):
        p, q = theta * begin[:, None], (1 - theta) * carry[:, None]
        e = own * p / (p + q)
        b, c = sure + e.sum(1), every - e.sum(1)
        begin = np.maximum(b / ((like * b).sum() or 1), floor_begin)
        carry = np.maximum(c / ((like * c).sum() or 1), floor_carry)
        theta = (like @ e + 0.5) / (of_delimiter + 1)
    return dict(zip(behind, theta.tolist(), strict=True)), begin, carry


class Model:
    """theta, begin, carry and freq of one column, by EM.

    counts: (key, delimiter, shape) -> n; values: (key, delimiter before, delimiter behind, text) -> n; total: pieces of
    the column, if counts hold only those of some keys.
    """

    def __init__(self, counts: dict[tuple, int] | None = None, values: dict[tuple, int] | None = None, rounds: int = ROUNDS, total: int | None = None) -> None:
        self._weights: dict[tuple, tuple[float, float]] = {}
        self.theta: dict[tuple, float] = {}
        self.begin: dict[tuple, float] = {}
        self.carry: dict[tuple, float] = {}
        self.freq: dict[tuple, float] = {}
        #: known values of several pieces by their first piece, and the most pieces of one
        self.starts: dict[tuple, int] = {}
        by_key: dict = {}
        for (key, delimiter, s), n in (counts or {}).items():
            of = by_key.setdefault(key, {}).setdefault(s, {})
            of[delimiter] = of.get(delimiter, 0) + n
        for key, of in by_key.items():
            theta, begin, carry = shape_model([(r, 1) for r in of.values()], rounds)
            self.theta |= {(key, d): t for d, t in theta.items()}
            self.begin |= {(key, s): x for s, x in zip(of, begin.tolist(), strict=True)}
            self.carry |= {(key, s): x for s, x in zip(of, carry.tolist(), strict=True)}
        seen: Counter = Counter()
        for (key, before, behind, text), n in (values or {}).items():
            several = len(pieces(text, False)) > 1
            seen[(key, text if several else unquoted(text), several)] += n * self.parts(key, before) * self.parts(key, behind)
        self.learn(seen, total or sum((counts or {}).values()) or 1, rounds)

    def parts(self, key: str | None, delimiter: str) -> float:
        """How likely the delimiter parts values of the key."""
        if delimiter in (FIRST, KEYED, LAST):
            return 1.0
        return min(max(self.theta.get((key, delimiter), 0.5), 1e-6), 1 - 1e-6)

    def learn(self, seen: dict[tuple, float], total: int, rounds: int = ROUNDS) -> Counter:
        """EM over whole values: each round weighs spans of several pieces by the lattice of the round before. Gives how
        often each value is expected. seen: (key, text, of several pieces) -> n, weighed by the delimiters around it."""
        sure: Counter = Counter()
        spans = []
        for (key, text, several), n in seen.items():
            if several:
                spans.append((key, text, n, pieces(text, False)))
            else:
                sure[(key, text)] += n
        expected = sure
        for i in range(rounds if spans else 1):
            self.know({v: math.log(KNOWN * n / total) for v, n in expected.items() if n >= 1.5})
            expected, kept = Counter(sure), []
            for span in spans:
                key, text, n, found = span
                apart = self.total(key, found, False)
                one = self.arc(key, found, 0, len(found)) if i else math.log(KNOWN * n / total)
                # a span that recurs by chance saves less than it takes to spell it once; what is known later only adds to apart
                if n >= 1.5 and n * (math.log(KNOWN * n / total) - apart) > _letters(text):
                    kept.append(span)
                    expected[(key, text)] += n * math.exp(one - _add(one, apart))
            spans = kept
        self.know({v: math.log(KNOWN * n / total) for v, n in expected.items() if n >= 1.5})
        return expected

    def know(self, freq: dict[tuple, float]) -> None:
        self.freq, self.starts = freq, {}
        for key, text in freq:
            if not _STOPS.search(text):
                continue
            found = pieces(text, False)
            if len(found) > 1:
                at = (key, found[0][2])
                self.starts[at] = max(self.starts.get(at, 0), len(found))

    def weights(self, key: str | None, delimiter: str, text: str) -> tuple[float, float]:
        """Log-likelihoods of a piece that begins an unknown value, and of one that carries on."""
        at = (key, delimiter, shape(unquoted(text)))
        known = self._weights.get(at)
        if known is None:
            t, s = self.parts(key, delimiter), at[2]
            b, c = self.begin.get((key, s), 1e-4), self.carry.get((key, s), 1e-5)
            known = math.log(t * b), math.log((1 - t) * c) if t < 1 else -math.inf
            if len(self._weights) < HELD:
                self._weights[at] = known
        return known

    def known(self, key: str | None, found: list, i: int, j: int) -> float | None:
        """Log-likelihood of pieces i..j-1 as one known value, with the delimiter before it parting; None if it's unknown."""
        own = self.freq.get((key, unquoted(written(found, i, j))))
        if own is None:
            return None
        return own + math.log(self.parts(key, found[i][0])) + sum(math.log(1 - self.parts(key, f[0])) for f in found[i + 1 : j])

    def arc(self, key: str | None, found: list, i: int, j: int) -> float:
        """Log-likelihood of pieces i..j-1 as one value, known or not."""
        w = [self.weights(key, f[0], f[2]) for f in found[i:j]]
        unknown = w[0][0] + sum(x[1] for x in w[1:]) - sum(_letters(f[2]) for f in found[i:j])
        known = self.known(key, found, i, j)
        return unknown if known is None else _add(unknown, known)

    def total(self, key: str | None, found: list, whole: bool = True) -> float:
        """Log-likelihood of the pieces over all splits, or those into several values; for the pieces of a counted span."""
        n = len(found)
        sums = [0.0] + [-math.inf] * n
        for j in range(1, n + 1):
            for i in range(0 if whole or j < n else 1, j):
                sums[j] = _add(sums[j], sums[i] + self.arc(key, found, i, j))
        return sums[n]


def _add(a: float, b: float) -> float:
    low, high = min(a, b), max(a, b)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def written(found: list, i: int, j: int) -> str:
    """Pieces i..j-1 as they stand in the field."""
    return found[i][2] if j == i + 1 else found[i][2] + "".join(f[3] + f[2] for f in found[i + 1 : j])


def viterbi(found: list, model: Model) -> list[tuple[str | None, str, bool]]:
    """(key, value as written, quoted) of the likeliest split of a field's pieces.

    Node i of the lattice is the place before piece i; an arc from i to j is the value of pieces i..j-1. No arc runs
    across a piece that begins a value for certain. Arcs of unknown values are carried along from piece to piece; from
    a piece that begins a known value of several, its arcs are looked up one by one.
    """
    n = len(found)
    keys: list[str | None] = []
    for _, key, *_ in found:
        keys.append(key if key is not None else (keys[-1] if keys else None))
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    # the best unknown value that is open before piece i, and where it began
    open_score, open_at = -math.inf, 0
    for i in range(n):
        delimiter, own, text = found[i][:3]
        k = keys[i]
        sure = i == 0 or own is not None
        if sure and (i + 1 == n or found[i + 1][1] is not None):  # a piece between two certain places is a value
            best[i + 1], back[i + 1], open_score = best[i], i, -math.inf
            continue
        begin, carry = (0.0, -math.inf) if sure else model.weights(k, delimiter, text)
        cost = _letters(text)
        fresh, carried = best[i] + begin - cost, open_score + carry - cost
        if carried > fresh:
            open_score = carried
        else:
            open_score, open_at = fresh, i
        if open_score > best[i + 1]:
            best[i + 1], back[i + 1] = open_score, open_at
        longest = model.starts.get((k, text), 1)
        t = 0.0 if sure else math.log(model.parts(k, delimiter))
        inner = 0.0
        for j in range(i + 1, min(n, i + longest) + 1):
            if j > i + 1:
                if found[j - 1][1] is not None:
                    break
                inner += math.log(1 - model.parts(k, found[j - 1][0]))
            own_freq = model.freq.get((k, unquoted(text) if j == i + 1 else written(found, i, j)))
            if own_freq is not None and (score := best[i] + t + own_freq + inner) > best[j]:
                best[j], back[j] = score, i
    cuts, j = [], n
    while j:
        cuts.append((back[j], j))
        j = back[j]
    return [(keys[i], written(found, i, j), found[i][4] and j == i + 1) for i, j in reversed(cuts)]


class Frequent:
    """A frequent-item summary: of n values put in, each loses at most n / kept of its count, and kept are left."""

    def __init__(self, kept: int = KEPT) -> None:
        self.kept, self.counts, self.lost = kept, Counter(), 0

    def trim(self) -> None:
        if len(self.counts) > self.kept:
            least = sorted(self.counts.values(), reverse=True)[self.kept]
            self.lost += least
            self.counts = Counter({v: n - least for v, n in self.counts.items() if n > least})

    def update(self, values: list) -> None:
        self.counts.update(values)
        if len(self.counts) > 4 * self.kept:
            self.trim()


def segments(found: list) -> Iterator[tuple[int, int, str | None]]:
    """(from, to, key) of the pieces from one certain place to the next."""
    begun, key = 0, None
    for i, (_, own, *_) in enumerate(found):
        if own is not None:
            if i:
                yield begun, i, key
            begun, key = i, own
    if found:
        yield begun, len(found), key


def _around(found: list, i: int, j: int, end: int) -> tuple[str, str]:
    """The delimiters before and behind pieces i..j-1 of a segment that ends before piece `end`."""
    before = KEYED if found[i][1] is not None and found[i][0] != FIRST else found[i][0]
    return before, LAST if j == end else found[j][0]


def _hash(key: str | None, text: str, below: int = BITS) -> int:
    return zlib.crc32(f"{key or ''}\x00{text}".encode()) % below


def _sums(counts: Counter, values: bool) -> pa.RecordBatch:
    """(key, delimiter, behind, text, n) of (key, delimiter, shape), or with `values` of (key, before, behind, text)."""
    rows = list(counts)
    behind = [r[2] for r in rows] if values else [None] * len(rows)
    return pa.record_batch({"key": pa.array([r[0] for r in rows], pa.string()), "delimiter": pa.array([r[1] for r in rows], pa.string()), "behind": pa.array(behind, pa.string()), "text": pa.array([r[-1] for r in rows], pa.string()), "n": pa.array(list(counts.values()), pa.int64())})


def _hashed(sums: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums with h, a hash of the key and of the text without quotes."""
    for b in sums:
        h = [_hash(k, _bare(t), 1 << 31) for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True)]
        yield b.append_column("h", pa.array(h, pa.int32()))


def _bare(text: str) -> str:
    """The same for a text with quotes around it and without."""
    q = text[:1]
    return text[1:-1].replace(q + q, q).strip() if q in _QUOTED and len(text) > 1 and text[-1] == q else text


def parsed(rows: DataFrame, keyed: bool) -> DataFrame:
    """(rec, found, n, open) of (rec, text): a field's pieces in marshal's form, how many there are, and the keys under
    which a place between two of them is open ("" for none)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [pieces(t, keyed) for t in b.column(1).to_pylist()]
            opened = [list({k or "" for begun, end, k in segments(f) if end > begun + 1}) for f in each]
            yield pa.record_batch({"rec": b.column(0), "found": pa.array([marshal.dumps(f) for f in each], pa.binary()), "n": pa.array([len(f) for f in each], pa.int32()), "open": pa.array(opened, pa.list_(pa.string()))})

    return cut(rows.mapInArrow(parse, "rec string, found binary, n int, open array<string>"), "parsed")


def _found(column: pa.Array, keyed: bool) -> Iterator[list]:
    """Pieces of each field of a column of texts, or of what parsed() made of them."""
    held = column.to_pylist()
    return map(marshal.loads, held) if pa.types.is_binary(column.type) else (pieces(t, keyed) for t in held)


def count_pieces(batches: Iterator[pa.RecordBatch], keyed: bool, only: set | None = None) -> Iterator[pa.RecordBatch]:
    """Sums over a partition's fields: (key, delimiter, shape) with its count, and (key, delimiter, behind, text) of the
    pieces of fields that have several. only: the keys to count, "" for none."""
    counts: Counter = Counter()
    values: Counter = Counter()
    for batch in batches:
        for found in _found(batch.column(0), keyed):
            for begun, end, key in segments(found):
                if only is not None and (key or "") not in only:
                    continue
                for i in range(begun, end):
                    delimiter, own, text, _, quoted = found[i]
                    counts[(key, KEYED if own is not None and delimiter != FIRST else delimiter, shape(unquoted(text) if quoted else text))] += 1
                    if len(found) > 1:
                        values[(key, *_around(found, i, i + 1, end), text)] += 1
            for held, of_values in ((counts, False), (values, True)):
                if len(held) > HELD:
                    yield _sums(held, of_values)
                    held.clear()
    for held, of_values in ((counts, False), (values, True)):
        if held:
            yield _sums(held, of_values)


def count_spans(batches: Iterator[pa.RecordBatch], keyed: bool, short: int, often: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, delimiter, behind, text, n) of the spans of more than `short` pieces, up to LONGER times that, whose spans of
    `short` pieces all recur. often: the hashes of these."""
    values: Counter = Counter()
    for batch in batches:
        for found in _found(batch.column(0), keyed):
            for begun, end, key in segments(found):
                if end - begun <= short:
                    continue
                recurs = [often[_hash(key, written(found, i, i + short))] for i in range(begun, end - short + 1)]
                for i in range(begun, end - short):
                    if not recurs[i - begun]:
                        continue
                    for j in range(i + short + 1, min(end, i + LONGER * short) + 1):
                        if not recurs[j - short - begun]:
                            break
                        values[(key, *_around(found, i, j, end), written(found, i, j))] += 1
                    if len(values) > HELD:
                        yield _sums(values, True)
                        values.clear()
    if values:
        yield _sums(values, True)


_COUNTED = "key string, delimiter string, behind string, text string, n bigint"


def _recurring(counted: DataFrame, several: bool) -> DataFrame:
    """(key, delimiter, behind, text, n, pieces) of counted sums (with their h), summed up: those of shapes, and those of
    values that occur at least twice, with quotes or without. several: pieces of a value are counted, else they are null.

    Sums of one h meet in order in one task, which holds a batch and the sums of the last h.
    """

    def each(t: pa.Table) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for *at, n in zip(*(t[c].to_pylist() for c in ("key", "delimiter", "behind", "text", "n")), strict=True):
            sums[tuple(at)] += n
        occurs: Counter = Counter()
        for (key, _, behind, text), n in sums.items():
            if behind is not None:
                occurs[key, _bare(text)] += n
        kept = [(*at, n) for at, n in sums.items() if at[2] is None or occurs[at[0], _bare(at[3])] > 1]
        if kept:
            key, delimiter, behind, text, n = zip(*kept, strict=True)
            count = [len(pieces(x, False)) if several else None for x in text]
            yield pa.record_batch({"key": pa.array(key, pa.string()), "delimiter": pa.array(delimiter, pa.string()), "behind": pa.array(behind, pa.string()), "text": pa.array(text, pa.string()), "n": pa.array(n, pa.int64()), "pieces": pa.array(count, pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            h = b.column("h").to_numpy()
            begins = int(np.searchsorted(h, h[-1]))
            # what stands before the last h of the batch is whole
            if waiting and h[0] != waiting[-1].column("h")[0].as_py() or begins:
                yield from shared(pa.Table.from_batches([*waiting, b.slice(0, begins)]))
                waiting = []
            waiting.append(b.slice(begins))
        if waiting:
            yield from shared(pa.Table.from_batches(waiting))

    def shared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Without the values that have an h and a count of one."""
        h, n = t["h"].to_numpy(), t["n"].to_numpy()
        again = np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]
        again[:-1] |= again[1:]
        return each(t.filter(pa.array(again | (n > 1) | t["behind"].is_null().to_numpy())))

    return counted.repartition("h").sortWithinPartitions("h").mapInArrow(run, _COUNTED + ", pieces int")


def _filter(keyed_texts: DataFrame) -> np.ndarray | None:
    """A filter of the hashes of (key, text), BITS at most; None if there are no rows."""
    found = keyed_texts.select(F.pmod(F.crc32(F.concat(F.coalesce("key", F.lit("")), F.lit("\x00"), "text").cast("binary")), F.lit(BITS)).cast("int").alias("h")).distinct().toArrow()
    if not found.num_rows:
        return None
    bits = np.zeros(BITS, bool)
    bits[found["h"].to_numpy()] = True
    return bits


def count(fields: DataFrame, keyed: bool) -> tuple[DataFrame, list[DataFrame]]:
    """(key, delimiter, text, n) of all shapes, and (key, delimiter, behind, text, n) of all values that occur at least
    twice, pass by pass. fields: one column of texts, or the table of parsed(), of which only the keys are counted that are
    open anywhere, as the others' values are never asked for."""
    hidden, only = fields, None
    if "open" in fields.columns:
        keys = [r[0] for r in fields.select(F.explode("open")).distinct().limit(LOCAL + 1).collect()] if LOCAL > 0 else []
        # beyond what the driver holds, all of them are counted
        only = {*keys} if 0 < LOCAL >= len(keys) else None
        hidden, fields = fields.where(F.size("open") > 0).select("found"), fields.select("found")
    table = cut(_recurring(fields.mapInArrow(lambda bs: _hashed(count_pieces(bs, keyed, only)), _COUNTED + ", h int"), False), "pieces")
    shapes, values, short = table.where("behind is null").drop("behind", "pieces"), [table.where("behind is not null")], 1
    # the longest spans of a pass tell where the next has to look
    while (often := _filter(values[-1].where(F.col("pieces") == short) if short > 1 else values[-1])) is not None:
        longer = hidden.mapInArrow(lambda bs, n=short, o=often: _hashed(count_spans(bs, keyed, n, o)), _COUNTED + ", h int")
        short *= LONGER
        values.append(cut(_recurring(longer, True), "values"))
    return shapes, [v.drop("pieces") for v in values]


def fit(fields: DataFrame, keyed: bool = True) -> Model | DataFrame:
    """The model of a column; fields: as for count(). If it is too large for one place, the table of its entries:
    (key, kind, text, x, y) of delimiters (theta), shapes (begin and carry) and values (log-frequency)."""
    shapes, passes = count(fields, keyed)
    values = reduce(DataFrame.unionByName, passes)
    size = lambda df: df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    rows, letters = map(sum, zip(size(shapes), size(values), strict=True))
    total = fields.agg(F.sum("n")).first()[0] if "n" in fields.columns else shapes.agg(F.sum("n")).first()[0]
    if rows > LOCAL or letters > LETTERS:
        return entries(shapes, values, total or 1)
    counts = {(r["key"], r["delimiter"], r["text"]): r["n"] for r in shapes.collect()}
    return Model(counts, {(r["key"], r["delimiter"], r["behind"], r["text"]): r["n"] for r in values.collect()}, total=total)


_ENTRY = "key string, kind string, text string, x double, y double"


def _classes(key: tuple, t: pa.Table) -> pa.Table:
    """Entries of a key's delimiters, and of its classes of shapes under their counts."""
    rows = [(json.loads(s), m) for s, m in zip(t["same"].to_pylist(), t["m"].to_pylist(), strict=True)]
    theta, begin, carry = shape_model([({d: n for d, n in r}, m) for r, m in rows])
    n = len(theta)
    return pa.table({"key": pa.array([key[0].as_py()] * (n + len(rows)), pa.string()), "kind": ["d"] * n + ["c"] * len(rows), "text": pa.array([*theta, *t["same"].to_pylist()], pa.string()), "x": pa.array([*theta.values(), *begin], pa.float64()), "y": pa.array([0.0] * n + [*carry], pa.float64())})


def entries(shapes: DataFrame, values: DataFrame, total: int) -> DataFrame:
    """The entries of a model; every step takes a bounded part of them at a time. total: pieces of the column."""
    keyed = F.coalesce("key", F.lit("")).alias("key")
    # shapes of a key with the same counts have the same weights
    same = shapes.groupBy(keyed, "text").agg(F.to_json(F.sort_array(F.collect_list(F.array("delimiter", F.col("n").cast("string"))))).alias("same"))
    same = cut(same.withColumn("same", F.regexp_replace("same", r'"(\d+)"\]', r"$1]")), "classes")
    learned = cut(same.groupBy("key", "same").agg(F.count(F.lit(1)).alias("m")).groupBy("key").applyInArrow(_classes, _ENTRY), "entries")
    of_shapes = same.join(learned.where("kind = 'c'").select("key", F.col("text").alias("same"), "x", "y"), ["key", "same"]).select("key", F.lit("s").alias("kind"), "text", "x", "y")
    theta = learned.where("kind = 'd'")
    # values weighed by the delimiters around them
    w = values.withColumn("key", keyed)
    for side in ("delimiter", "behind"):
        w = w.join(theta.select("key", F.col("text").alias(side), F.col("x").alias(f"_{side}")), ["key", side], "left")
    part = lambda side: F.when(F.col(side).isin(FIRST, KEYED, LAST), F.lit(1.0)).otherwise(F.least(F.greatest(F.coalesce(f"_{side}", F.lit(0.5)), F.lit(1e-6)), F.lit(1 - 1e-6)))

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            several = [len(pieces(t, False)) > 1 for t in texts]
            yield pa.record_batch({"key": b.column("key"), "kind": ["m" if s else "o" for s in several], "text": pa.array([t if s else unquoted(t) for t, s in zip(texts, several, strict=True)], pa.string()), "x": b.column("w")})

    w = w.select("key", "text", (F.col("n") * part("delimiter") * part("behind")).alias("w")).mapInArrow(bare, "key string, kind string, text string, x double")
    seen = cut(w.groupBy("key", "kind", "text").agg(F.sum("x").alias("x")), "seen").withColumn("y", F.lit(0.0))
    given = cut(of_shapes.unionByName(theta).unionByName(seen), "entries")
    # spans of several pieces by EM, each with all spans within it
    spans = seen.where("kind = 'm'").select(F.col("key").alias("rec"), "text")

    def ask(key: str, text: str) -> set:
        found = pieces(text, False)
        out = {(key, "d", d) for d in DELIMITERS} | {(key, "s", shape(unquoted(f[2]))) for f in found}
        within = {unquoted(written(found, i, j)) for i in range(len(found)) for j in range(i + 1, len(found) + 1)}
        return out | {(key, kind, v) for v in within for kind in "om"}

    def expect(items: pa.Table, model: Model, seen: dict) -> pa.Table:
        n = model.learn(seen, total)
        got = [n[(k or None, t)] for k, t in zip(items["rec"].to_pylist(), items["text"].to_pylist(), strict=True)]
        return pa.table({"key": items["rec"], "text": items["text"], "x": pa.array(got, pa.float64())})

    several = _by_group(spans, ask, given, expect, "key string, text string, x double")
    alone = seen.where("kind = 'o'").join(spans.select(F.col("rec").alias("key"), "text"), ["key", "text"], "left_anti").select("key", "text", "x")
    known = several.unionByName(alone).where("x >= 1.5").select("key", F.lit("v").alias("kind"), "text", F.log(F.col("x") * (KNOWN / total)).alias("x"), F.lit(0.0).alias("y"))
    return cut(of_shapes.unionByName(theta).unionByName(known), "entries")


def _by_group(items: DataFrame, ask: Callable, table: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run(items, model, counts of values) over groups of items (rec and another column), each with the entries that ask(rec,
    the other) names."""
    groups = max(1, -(-items.count() // GROUP))
    items = items.select("*", F.pmod(F.xxhash64(*items.columns), F.lit(groups)).cast("int").alias("g"))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in range(0, b.num_rows, 1000):
                x = b.slice(part, 1000)
                rows = list({(g, *e) for r, t, g in zip(*(c.to_pylist() for c in x.columns), strict=True) for e in ask(r, t)})
                yield pa.record_batch({n: pa.array([r[i] for r in rows], pa.int32() if n == "g" else pa.string()) for i, n in enumerate(("g", "key", "kind", "text"))})

    wanted = items.mapInArrow(asked, "g int, key string, kind string, text string").distinct().join(table, ["key", "kind", "text"])

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        model, seen, freq = Model(), {}, {}
        for key, kind, text, x, y in zip(*(right[c].to_pylist() for c in ("key", "kind", "text", "x", "y")), strict=True):
            k = key or None
            if kind == "d":
                model.theta[(k, text)] = x
            elif kind == "s":
                model.begin[(k, text)], model.carry[(k, text)] = x, y
            elif kind == "v":
                freq[(k, text)] = x
            else:
                seen[(k, text, kind == "m")] = x
        model.know(freq)
        return run(left, model, seen)

    return items.groupBy("g").cogroup(wanted.groupBy("g")).applyInArrow(both, schema)


def _long(table: DataFrame) -> tuple[np.ndarray | None, int]:
    """A filter of the first pieces of known values of several, and the most pieces of one."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, f[0][2], len(f)) for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True) if len(f := pieces(t, False)) > 1]
            yield pa.record_batch({"key": pa.array([r[0] for r in rows], pa.string()), "text": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int32())})

    found = cut(table.where("kind = 'v'").select("key", "text").mapInArrow(firsts, "key string, text string, n int"), "firsts")
    return _filter(found), found.agg(F.max("n")).first()[0] or 1


def split_packed(df: DataFrame, key: Column | str, field: str, name: str | None = None, keyed: bool = True) -> DataFrame:
    """(rec_key, pos, attr_name, item_value): one row per value of each field that holds at least two.

    pos counts values from 1 over the field. attr_name is the key before the value (key=value or key "value"; further
    values of a list have the key of the list), or name if the column has no keys (keyed=False). Values are without
    outer blanks and enclosing quotes, a doubled quote inside made single; empty values are dropped and not counted;
    square brackets round the whole field are no part of it. Quotes enclose only from the start of a value to its end.
    Rows with a null key or field give nothing; rows alike in both count once; other columns don't matter; an empty
    table gives no rows.
    """
    rows = df.select((F.col(key) if isinstance(key, str) else key).cast("string").alias("rec"), F.col(field).alias("text")).where("rec is not null and text is not null")
    # a field without a delimiter between two texts has one value at most
    core = F.btrim("text", F.lit(DELIMITERS + "[] "))
    rows = parsed(rows.where(core.rlike(_STOPS.pattern)).distinct(), keyed)
    model = fit(rows, keyed)
    schema = "rec_key string, pos int, attr_name string, item_value string"

    def split(recs: list, held: list, model: Model | None) -> dict[str, pa.Array]:
        ids, pos, names, values = [], [], [], []
        for rec, found in zip(recs, map(marshal.loads, held), strict=True):
            units = ((f[1], f[2], f[4]) for f in found) if model is None else viterbi(found, model)
            units = [(k, v) for k, v in ((k, unquoted(v) if q else v) for k, v, q in units) if v]
            if len(units) > 1:
                ids += [rec] * len(units)
                pos += range(1, len(units) + 1)
                names += [k for k, _ in units] if keyed else [name] * len(units)
                values += [v for _, v in units]
        return {"rec_key": pa.array(ids, pa.string()), "pos": pa.array(pos, pa.int32()), "attr_name": pa.array(names, pa.string()), "item_value": pa.array(values, pa.string())}

    def split_all(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch(split(b.column(0).to_pylist(), b.column(1).to_pylist(), model))

    # where no place is open each piece is a value
    several = rows.where("n > 1").select("rec", "found", (F.size("open") > 0).alias("open"))
    plain, rows = (several.where(c).drop("open") for c in ("not open", "open"))
    plain = plain.mapInArrow(lambda bs: split_all(bs, None), schema)
    if isinstance(model, Model):
        return plain.unionByName(rows.mapInArrow(lambda bs: split_all(bs, model), schema))
    first, longest = _long(model)

    def ask(_: str, held: bytes) -> set:
        out, found = set(), marshal.loads(held)
        for begun, end, k in segments(found):
            if end == begun + 1:
                continue
            k = k or ""
            out |= {(k, "d", d) for d in DELIMITERS}
            for i in range(begun, end):
                out |= {(k, "s", shape(unquoted(found[i][2]))), (k, "v", unquoted(found[i][2]))}
                if first is not None and first[_hash(k, found[i][2])]:
                    out |= {(k, "v", written(found, i, j)) for j in range(i + 2, min(end, i + longest) + 1)}
        return out

    return plain.unionByName(_by_group(rows, ask, model, lambda items, m, _: pa.table(split(items["rec"].to_pylist(), items["found"].to_pylist(), m)), schema))
