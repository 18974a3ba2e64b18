"""Sentence units of texts in any language: one pushdown automaton over lists, quotes and brackets.

The automaton reads lines, marks and terminators. Its stack holds the open levels of nested lists, and above them the open
marks of the block it is in. A blank line closes the block; a list line closes the levels that are deeper than it, opens
its own if it has none, and begins a block of its own. An opening mark is pushed, a closing one pops its partner and what
stands above it. A terminator goes to the state on top: at the bottom it may end a unit; under a mark it waits. When the
mark closes, what waits under it is dropped, but for a terminator right before the closing mark, which is handed down; when
the block closes with a mark still open, the mark opened nothing, and what waits under it may end units after all.

A terminator ends a unit if what stands before it is no abbreviation, initial, ordinal or decimal and what follows may
begin a sentence. The word before a full stop is looked up, last letter first, in a trie of abbreviations. Scripts bring
their own terminators; Thai has none and parts sentences by a blank between two Thai letters. Each character is read once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
#: Abbreviations that never end a sentence.
NEVER = "dr prof mr mrs ms st dra sr sra srta mme mlle mm vs cf vgl bzw sp subsp var e.g i.e z.b d.h u.a p.ex p.ej p.e u.s डॉ श्री डा проф акад ул г-н т.е т.п см ср напр д-р أ.د".split()
#: Abbreviations that end none before a number or bracket.
NUMBERED = "no nos nr fig figs tab tabs abb sect sec ref refs max min ca approx aprox env núm num pág pag vol ch chap art p pp s bd kap рис табл стр гл approximately том n°".split()
#: Abbreviations that end a sentence if the next word is written large.
OFTEN = "etc usw al nov ff a.m p.m jr co inc ltd".split()
#: What stands before a German day or ordinal.
BEFORE_ORDINAL = frozenset("am im vom zum beim der die das dem den des jede jeder jedes ein eine einer bis seit ab und".split())
LONGEST_BEFORE = 1 + max(map(len, BEFORE_ORDINAL))
MONTHS = frozenset("januar februar märz april mai juni juli august september oktober november dezember jahrhundert".split())
PAIRS = {"“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "《": "》", "〈": "〉", "〔": "〕", '"': '"', "＂": "＂"}
CLOSERS = "”“»›」』)]}）】》〉〕\"＂’'"
IDEOGRAPHIC, STRONG, WEAK = "。！？｡．", "।॥؟۔!?‼⁇⁈⁉", ".…"
#: What goes on with a sentence after quoted speech in Chinese and Japanese.
GOES_ON = "とはがをにのもで、，,：；:;的地得"

_MARKS = "".join(sorted({*PAIRS, *"".join(PAIRS.values())}))
_ENDS = re.escape(IDEOGRAPHIC + STRONG + WEAK)
_EVENT = re.compile(f"[{re.escape(_MARKS)}]|[{_ENDS}]+")
_THAI_LETTER = re.compile(r"[฀-๿]")
_THAI_EVENT = re.compile(_EVENT.pattern + r"|(?<=[฀-๿!?.])\s+(?=[฀-๿])")
_LINE = re.compile(r"[^\r\n\x85\u2028\u2029]*(?:\r\n|[\r\n\x85\u2028\u2029]|$)")
_VISIBLE, _WORD = re.compile(r"\S"), re.compile(r"\w+")
_BEFORE_WORD = frozenset("([{\"“„«'‘（")
_BULLET = re.compile(r"\s*[-*•‣◦▪●·–—+]\s+\S")
_NUMBER = re.compile(r"\s*\(?(\d+)[.)]\s+\S")
#: A list may begin with a number below this (a line may begin with a year); it may go on to any number.
FIRST_NUMBER = 1000
#: Says that a terminator is a blank between Thai letters.
BLANK = -1
_LETTER = re.compile(r"\s*\(?[A-Za-z]\)\s+\S")
_CJK = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿]")


def _trie(words: list[str], tag: str, root: dict) -> None:
    for word in words:
        node = root
        for c in reversed(word):
            node = node.setdefault(c, {})
        node[""] = tag


ABBREVIATIONS: dict = {}
_trie(OFTEN, "often", ABBREVIATIONS)
_trie(NUMBERED, "numbered", ABBREVIATIONS)
_trie(NEVER, "never", ABBREVIATIONS)


def abbreviation(text: str, at: int, low: int) -> str | None:
    """The tag of the abbreviation that ends before text[at]; its first letter follows no letter or digit."""
    node, i, tag = ABBREVIATIONS, at - 1, None
    while i >= low and (node := node.get(text[i].lower())):
        if "" in node and (i == low or not (text[i - 1].isalnum() or text[i - 1] in "._")):
            tag = node[""]
        i -= 1
    return tag


class Level:
    """An open level of a list: its indent and the number of its last line, if they are numbered."""

    __slots__ = ("indent", "number")

    def __init__(self, indent: int, number: int | None) -> None:
        self.indent, self.number = indent, number


class Mark:
    """An open mark, the place of it and the terminators that wait under it."""

    __slots__ = ("at", "partners", "waiting")

    def __init__(self, at: int, partners: str) -> None:
        self.at, self.partners, self.waiting = at, partners, []


class Automaton:
    """Reads a text line by line and says where its blocks and the terminators that count are.

    lists is the lower part of the stack, marks the upper part. A terminator is (from, to, stop, opened): what stands
    from..to (BLANK for a Thai blank), up to stop with a closing mark behind it, whose opening mark is at opened, else -1.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.lists: list[Level] = []
        self.marks: list[Mark] = []
        self.awaited: dict[str, int] = {}
        self.ready: list[tuple[int, int, int, int]] = []

    def is_item(self, line: str, before: str, start: int, end: int) -> bool:
        """Whether a line is one of a list, and the levels open after it. before: what the line before was; start, end:
        the block so far."""
        bullet = _BULLET.match(line) or _LETTER.match(line)
        numbered = None if bullet else _NUMBER.match(line)
        if not bullet and not numbered:
            return False
        indent = len(line) - len(line.lstrip())
        k = int(numbered[1]) if numbered and len(numbered[1]) < 18 else None
        if bullet:
            self._close(indent)
            if not self.lists or self.lists[-1].indent < indent:
                self.lists.append(Level(indent, None))
            return True
        if k is None:
            return False
        # the next number of an open level goes on with that level, at whatever indent
        for depth in range(len(self.lists) - 1, -1, -1):
            level = self.lists[depth]
            if before != "text" and level.number is not None and level.number + 1 == k:
                del self.lists[depth + 1 :]
                level.number = k
                return True
        if before == "text":
            opens = k == 1 and self.text[start:end].rstrip()[-1:] in ".:!?：。！？"
        else:
            deeper = bool(self.lists) and indent > self.lists[-1].indent
            opens = before == "blank" and k < FIRST_NUMBER or before == "list" and k == 1 and (deeper or self.lists[-1:] == [] or self.lists[-1].number is None)
        if opens:
            self._close(indent, True)
            self.lists.append(Level(indent, k))
        return opens

    def _close(self, indent: int, even: bool = False) -> None:
        while self.lists and (self.lists[-1].indent > indent or even and self.lists[-1].indent == indent):
            self.lists.pop()

    def blocks(self) -> Iterator[tuple[int, int, bool]]:
        """(from, to, is_list) of the blocks of lines that no unit crosses."""
        start, listed, before, end = None, False, "blank", 0
        for m in _LINE.finditer(self.text):
            if m.start() == m.end():
                break
            line = m.group()
            if not line.strip():
                if start is not None:
                    yield start, end, listed
                if before == "text":
                    self.lists.clear()
                start, before = None, "blank"
                continue
            item = self.is_item(line, before, start or 0, end)
            if item or start is None:
                if start is not None:
                    yield start, end, listed
                start, listed = m.start(), item
            if not item and not listed:
                self.lists.clear()
            end, before = m.end(), "list" if listed else "text"
        if start is not None:
            yield start, end, listed

    def _put(self, event: tuple[int, int, int, int]) -> None:
        (self.marks[-1].waiting if self.marks else self.ready).append(event)

    def _pop(self, at: int) -> None:
        """A closing mark closes the innermost open mark it is the partner of."""
        c = self.text[at]
        depth = next(i for i in range(len(self.marks) - 1, -1, -1) if c in self.marks[i].partners)
        gone = self.marks[depth:]
        del self.marks[depth:]
        for m in gone:
            for x in m.partners:
                self.awaited[x] -= 1
        last = next((m.waiting[-1] for m in reversed(gone) if m.waiting), None)
        if last is not None and last[1] != BLANK and not self.text[last[1] : at + 1].strip(CLOSERS + " \n\r\t\xa0\u202f"):
            self._put((last[0], last[1], at + 1, gone[0].at))

    def terminators(self, a: int, b: int) -> list[tuple[int, int, int, int]]:
        """The terminators of a block at the bottom of the stack, in order."""
        self.marks, self.awaited, self.ready = [], {}, []
        for m in (_THAI_EVENT if _THAI_LETTER.search(self.text, a, b) else _EVENT).finditer(self.text, a, b):
            c, at = m.group()[0], m.start()
            if c.isspace():  # between Thai letters
                self._put((at, BLANK, m.end(), -1))
            elif c in _MARKS:
                if self.awaited.get(c) and (c not in PAIRS or c == "“" or c == PAIRS[c]):
                    self._pop(at)
                elif c in PAIRS:
                    self.marks.append(Mark(at, PAIRS[c]))
                    for x in PAIRS[c]:
                        self.awaited[x] = self.awaited.get(x, 0) + 1
            else:
                self._put((at, m.end(), m.end(), -1))
        for left_open in self.marks:  # opened nothing
            self.ready += left_open.waiting
        return self.ready


def _ends(text: str, run: str, at: int, stop: int, begin: int, end: int, quoted: bool, opened_first: bool) -> bool:
    """Whether the run of terminators at text[at:] ends a unit, with closing marks up to stop; text[begin:] is the unit."""
    following = _VISIBLE.search(text, stop, end)
    if not following:
        return True
    nxt, blank = following.group(), following.start() > stop
    if any(c in IDEOGRAPHIC for c in run):
        return nxt not in GOES_ON and (opened_first or blank) if quoted else nxt not in "、，,；;"
    if run[0] == "…" or run.startswith(".."):
        return blank and nxt.isupper()
    if any(c in STRONG for c in run):
        if not blank:
            return not quoted and (run[0] in "।॥؟۔" or bool(_CJK.match(nxt)))
        return not quoted or not nxt.islower()
    if not blank or nxt.islower() or nxt in ",;:)]}»”":
        return False
    first = at
    while first > begin and not (text[first - 1].isspace() or text[first - 1] in _BEFORE_WORD):
        first -= 1
    w = text[first:at]
    if len(w) == 1 and w.isalpha():
        return False
    tag = abbreviation(text, at, begin)
    if tag == "never" or (tag == "numbered" and (nxt.isdigit() or nxt in "([")):
        return False
    if w.isdigit() and len(w) < 3 and nxt.isalpha():
        stop = first
        while stop > begin and text[stop - 1].isspace():
            stop -= 1
        low = stop
        while low > begin and not text[low - 1].isspace() and stop - low < LONGEST_BEFORE:
            low -= 1
        after = _WORD.match(text, following.start())
        if text[low:stop].lower() in BEFORE_ORDINAL or after and after.group().lower() in MONTHS:
            return False
    return True


def units(text: str) -> list[tuple[int, int]]:
    """(from, to) of the sentence units of a text, in order, without outer blanks; code points, to exclusive."""
    out: list[tuple[int, int]] = []

    def add(a: int, b: int) -> None:
        part = text[a:b]
        left = len(part) - len(part.lstrip())
        if left < len(part):
            out.append((a + left, a + len(part.rstrip())))

    automaton = Automaton(text)
    for a, b, listed in automaton.blocks():
        if listed:
            add(a, b)
            continue
        begin = a
        while begin < b and text[begin].isspace():
            begin += 1
        at = a
        for p, e, stop, opened in automaton.terminators(a, b):
            if p < at:
                continue
            if e == BLANK:
                if p > begin:
                    add(begin, p)
                    begin = at = stop
                continue
            while stop < b and (text[stop] in CLOSERS and text[stop] not in '"＂“' or text[stop] in IDEOGRAPHIC + STRONG + "."):
                stop += 1
            if _ends(text, text[p:e], p, stop, begin, b, opened >= 0, opened == begin):
                add(begin, stop)
                begin = stop
                while begin < b and text[begin].isspace():
                    begin += 1
                at = begin
        add(begin, b)
    return out


def sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sent_no, char_from, char_to): one row per sentence unit of every text, numbered from 1 in order.

    Offsets count code points from 0, char_to is exclusive; units have no outer blanks and keep closing marks. Headings
    between blank lines and list lines are units. A null or blank text has no units; a null key is kept; repeated rows
    give repeated units; other columns don't matter; an empty table gives no rows. Works row by row, without a shuffle.
    """
    kind = dict(df.dtypes)[key]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, lo, hi = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t:
                    for n, (a, b) in enumerate(units(t), 1):
                        at.append(i)
                        no.append(n)
                        lo.append(a)
                        hi.append(b)
            yield pa.record_batch({"key": batch.column(0).take(pa.array(at, pa.int32())), "sent_no": pa.array(no, pa.int32()), "char_from": pa.array(lo, pa.int32()), "char_to": pa.array(hi, pa.int32())})

    return df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(split, f"key {kind}, sent_no int, char_from int, char_to int").withColumnRenamed("key", key)
