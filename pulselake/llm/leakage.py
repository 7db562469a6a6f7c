"""Problem 9: passages of held-out test items inside documents.

All normalised items go into one generalised suffix automaton over words. A
document is streamed through it once, word by word; the automaton's state gives
the longest stretch ending here that occurs in any item, and where. Where a stretch stops
growing for all or some of the items that hold it, it is an anchor; an anchor
is extended along its item past single altered, dropped or inserted words. A
document leaks an item when the words so matched, not counting wording common
to many items, reach the length limit; ``cleaned`` removes every such span, and
those that cover most of an item though they are shorter.

The automaton is a few megabytes for a bounded item set: its size is checked
before it is sent to the executors, which build it once per worker. Larger sets
are matched in blocks of items, each block against all documents; a state with
one way on, as nearly all are, costs two numbers, so a block is large.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
import uuid
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
ANCHOR = 4
COMMON_GRAM = 8  # shorter runs recur by chance in items of one style
COMMON_ITEMS = 4
MAX_ITEM_WORDS = 20_000_000  # items are a bounded set; beyond this the call is refused
BLOCK_WORDS = 1_500_000  # words of items per automaton; some 300 MB in Python
COVERAGE, COVERED_WORDS = 0.8, 8  # a span is also removed if it covers that share of an item's own words and has so many

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ь": "b", "г": "r", "п": "n",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʟ": "l", "ᴏ": "o", "ʀ": "r", "ꜱ": "s", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ᴀ": "a", "ʙ": "b", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ɢ": "g", "ʜ": "h", "ɪ": "i", "ᴊ": "j", "ᴋ": "k", "ᴍ": "m", "ɴ": "n", "ᴘ": "p", "ᴛ": "t", "ʏ": "y", "ø": "o", "đ": "d", "ł": "l", "ß": "ss",
}
_TABLE = {c: None for c in range(0x20000) if unicodedata.combining(chr(c))} | {ord(k): v for k, v in LOOKALIKES.items()}
_TAG = re.compile(r"""</?[A-Za-z][\w:-]*(?:\s+[\w:.-]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+))?)*\s*/?>|<!--.*?-->""", re.S)
_LINK = re.compile(r"\]\([^()\s]*\)")
_UNIT = re.compile(r"\S+")
_WORD = re.compile(r"[a-z0-9]+")
_BROKEN = re.compile(r"[-‐‑](?<=[^\W\d_][-‐‑])[ \t]*\r?\n[>\s]*(?=[^\W\d_])")
_POINT = re.compile(r"(\d) ?[.,](?=\d)")
_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]")


def fold(text: str) -> str:
    """Lower-case Latin letters and digits, whatever the look of letters, markup, line ends or invisible characters."""
    if "\n" in text:
        text = _BROKEN.sub("", text)
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("", text)
    if "](" in text:
        text = _LINK.sub(" ", text)
    text = text.casefold()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_TABLE)
    return text


def words(text: str | None) -> list[str]:
    return _WORD.findall(_POINT.sub(r"\1", fold(text))) if text else []


def common_wording(items: list[tuple[int, list[str]]]) -> set[tuple[str, ...]]:
    """Runs of ``COMMON_GRAM`` words that ``COMMON_ITEMS`` or more items share."""
    seen: Counter = Counter()
    for _, ws in items:
        seen.update({tuple(ws[i : i + COMMON_GRAM]) for i in range(len(ws) - COMMON_GRAM + 1)})
    return {g for g, n in seen.items() if n >= COMMON_ITEMS}


def stock_words(ws: list[str], stock: set[tuple[str, ...]]) -> list[bool]:
    """Which words of an item are part of common wording."""
    flags = [False] * len(ws)
    for i in range(len(ws) - COMMON_GRAM + 1):
        if tuple(ws[i : i + COMMON_GRAM]) in stock:
            flags[i : i + COMMON_GRAM] = [True] * COMMON_GRAM
    return flags


class ItemAutomaton:
    """Generalised suffix automaton of word sequences, with where each state's stretches end."""

    def __init__(self, items: list[tuple[int, list[str]]], common: set[tuple[str, ...]] | None = None) -> None:
        """``common``: stock wording of the whole item set; by default that of ``items``."""
        stock = common_wording(items) if common is None else common
        self.ids: dict[str, int] = {}
        self.items = [(i, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for i, ws in items]
        # transitions: the only one of a state in two arrays, several in a dictionary of that state
        self.way, self.to = array("i", [-1]), array("i", [-1])
        self.ways: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, ws) in enumerate(self.items):
            last = 0
            for p, w in enumerate(ws):
                last = self._extend(last, w)
                ends[last].append((k, p))
        for s in sorted(range(1, len(self.way)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0 and self.length[self.link[s]] >= ANCHOR and s in ends:
                ends[self.link[s]] += ends[s]
        self.ends = dict(ends)  # of a state whose longest stretch is shorter than an anchor none is asked for
        self.common = [stock_words(ws, stock) for _, ws in items]
        self.own = [max(1, f.count(False)) for f in self.common]

    def _go(self, s: int, w: int) -> int:
        """The state after ``w``, or -1."""
        if self.way[s] == w:
            return self.to[s]
        many = self.ways.get(s)
        return many.get(w, -1) if many else -1

    def _lead(self, s: int, w: int, to: int) -> None:
        if self.way[s] in (-1, w):
            self.way[s], self.to[s] = w, to
        else:
            self.ways.setdefault(s, {})[w] = to

    def _state(self, length: int) -> int:
        self.way.append(-1)
        self.to.append(-1)
        self.link.append(0)
        self.length.append(length)
        return len(self.way) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.way[clone], self.to[clone] = self.way[q], self.to[q]
        if q in self.ways:
            self.ways[clone] = dict(self.ways[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self._go(p, w) == q:
            self._lead(p, w, clone)
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self._go(last, w)
        if q >= 0:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        cur, p = self._state(self.length[last] + 1), last
        while p >= 0 and self._go(p, w) < 0:
            self._lead(p, w, cur)
            p = self.link[p]
        if p >= 0:
            q = self._go(p, w)
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def anchors(self, doc: list[int]) -> Iterator[tuple[int, int, int]]:
        """``(state, end in document, length)`` of stretches of ``ANCHOR`` words or more that grow no further in all or some of the items that hold them."""
        state = length = 0
        go, link, size, ends = self._go, self.link, self.length, self.ends
        for i, w in enumerate(doc):
            if w < 0:  # a word of no item
                if length >= ANCHOR:
                    yield state, i - 1, length
                state = length = 0
                continue
            to = go(state, w)
            if to >= 0:
                if length >= ANCHOR and len(ends[to]) < len(ends[state]):
                    yield state, i - 1, length
                state, length = to, length + 1
                continue
            if length >= ANCHOR:
                yield state, i - 1, length
            while state > 0 and to < 0:
                state = link[state]
                length = size[state]
                to = go(state, w)
            if to >= 0:
                state, length = to, length + 1
            else:
                state = length = 0
        if length >= ANCHOR:
            yield state, len(doc) - 1, length

    def _grow(self, doc: list[int], item: list[int], i: int, j: int, step: int) -> tuple[int, int]:
        """Extend from document i and item j in one direction past single edits; the first places not matched."""
        n, m = len(doc), len(item)
        while 0 <= i < n and 0 <= j < m:
            if doc[i] == item[j]:
                i, j = i + step, j + step
                continue
            for di, dj in ((1, 1), (0, 1), (1, 0)):
                a, b = i + di * step, j + dj * step
                if 0 <= a < n and 0 <= b < m and doc[a] == item[b]:
                    a2, b2 = a + step, b + step
                    if 0 <= a2 < n and 0 <= b2 < m and doc[a2] == item[b2]:
                        i, j = a, b
                        break
            else:
                break
        return i, j

    def spans(self, ws: list[str]) -> list[tuple[int, int, int, int]]:
        """``(item, own words, first word, end)`` of each passage of an item among the words, single edits inside it included."""
        ids = self.ids
        doc = [ids.get(w, -1) for w in ws]
        found = []
        done: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for state, end, _ in self.anchors(doc):
            # a stretch shorter than its state's longest one ends wherever that one does
            for k, p in self.ends[state]:
                item, flags = self.items[k][1], self.common[k]
                if (end + 1 < len(doc) and p + 1 < len(item) and doc[end + 1] == item[p + 1]) or any(a <= end <= b for a, b in done[k]):
                    continue  # it grows on in this item, or is part of a passage found already
                ri, rj = self._grow(doc, item, end + 1, p + 1, 1)
                li, lj = self._grow(doc, item, end, p, -1)
                found.append((k, flags[lj + 1 : rj].count(False), li + 1, ri))
                done[k].append((li, ri))
        return found

    def longest(self, text: str | None) -> dict[int, tuple[int, float, int, int]]:
        """Per item of which ``text`` holds a passage: own words of the best one, the share of the item's own words, its first word and end."""
        best: dict[int, tuple[int, float, int, int]] = {}
        for k, n, a, b in self.spans(words(text)):
            if n > 0 and n > best.get(k, (0,))[0]:
                best[k] = (n, n / self.own[k], a, b)
        return {self.items[k][0]: v for k, v in best.items()}


def located_words(text: str) -> tuple[list[str], list[int], list[int]]:
    """The words of a text, and where in it the written unit of each begins and ends.

    A unit is a run without blanks, or several that a tag, comment, link or
    broken line joins. The few texts where units normalise differently apart
    than together are matched word by word.
    """
    glued: list[list[int]] = []
    for a, b in sorted(m.span() for r in (_TAG, _LINK, _BROKEN, _POINT) for m in r.finditer(text)):
        if glued and a <= glued[-1][1]:
            glued[-1][1] = max(glued[-1][1], b)
        else:
            glued.append([a, b])
    joined: list[list[int]] = []
    g = 0
    for a, b in (m.span() for m in _UNIT.finditer(text)):
        while g < len(glued) and joined and glued[g][1] <= joined[-1][1]:
            g += 1
        if joined and g < len(glued) and glued[g][0] < a:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    got: list[str] = []
    begin: list[int] = []
    end: list[int] = []
    for a, b in joined:
        for w in words(text[a:b]):
            got.append(w)
            begin.append(a)
            end.append(b)
    whole = words(text)
    if got == whole:
        return got, begin, end
    first, last, j = [0] * len(whole), [0] * len(whole), 0
    for block in difflib.SequenceMatcher(None, whole, got, autojunk=False).get_matching_blocks():
        for i in range(j, block.a):  # words that differ lie between their neighbours
            first[i] = last[i] = last[i - 1] if i else 0
        for i in range(block.size):
            first[block.a + i], last[block.a + i] = begin[block.b + i], end[block.b + i]
        j = block.a + block.size
    return whole, first, last


def _blocks(items: DataFrame, block_words: int) -> tuple[list[list[tuple[int, list[str]]]], set[tuple[str, ...]]]:
    """The items in blocks of so many words, and the wording common to many of them."""
    blocks: list[list[tuple[int, list[str]]]] = [[]]
    size = total = 0
    for r in items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text").orderBy("item_id").toLocalIterator():
        ws = words(r["text"])
        if (total := total + len(ws)) > MAX_ITEM_WORDS:
            raise ValueError(f"test items of more than {MAX_ITEM_WORDS} words; match them in several calls")
        if size + len(ws) > block_words and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append((r["item_id"], ws))
        size += len(ws)
    return blocks, common_wording([x for block in blocks for x in block])


_BUILT: dict[str, ItemAutomaton] = {}


def _built(key: str, made: tuple) -> ItemAutomaton:
    """The automaton of a block, built once per worker; the last one only is kept."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ItemAutomaton(*made)
    return _BUILT[key]


def leaked(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, n_words, coverage, first_word, end_word)`` of every document that holds a passage of an item.

    ``documents`` has ``doc_id, text``, ``items`` has ``item_id, text``. Of the
    best passage of an item: its own words, the share of the item's own words,
    and where it lies among the document's words. Null and empty texts hold
    nothing; items shorter than the limit cannot be found; a document that
    repeats a passage gives one row per item, repeated documents one each; other
    columns do not matter. No documents or items give no rows.
    """
    blocks, common = _blocks(items, block_words)
    parts = []
    for block in blocks:
        sent, key = documents.sparkSession.sparkContext.broadcast((block, common)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            automaton = _built(key, sent.value)
            for batch in batches:
                x = batch.to_pydict()
                got = [(d, i, *v) for d, t in zip(x["doc_id"], x["text"]) for i, v in automaton.longest(t).items() if v[0] >= min_words]
                cols = list(zip(*got)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32()))], ["doc_id", "item_id", "n_words", "coverage", "first_word", "end_word"])

        parts.append(documents.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, n_words int, coverage double, first_word int, end_word int"))
    return reduce(DataFrame.unionByName, parts)


def cleaned(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, text, spans_removed, chars_removed)``: every document without the passages of test items.

    A passage of an item is removed if its own words reach the length limit, or
    the share ``coverage`` of the item's own words and ``COVERED_WORDS``. What
    is left keeps its spelling; a blank stands where a passage was. Null texts
    stay null, texts without a passage as they are. Blocks of items are taken
    out one after the other, each in the same pass as its search.
    """
    blocks, common = _blocks(items, block_words)
    out = documents.select("doc_id", "text", F.lit(0).alias("spans_removed"), F.lit(0).alias("chars_removed"))
    for block in blocks:
        sent, key = documents.sparkSession.sparkContext.broadcast((block, common)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            automaton = _built(key, sent.value)
            for batch in batches:
                texts, spans, chars = (batch.column(c).to_pylist() for c in ("text", "spans_removed", "chars_removed"))
                for i, t in enumerate(texts):
                    gone = [(a, b) for k, n, a, b in automaton.spans(words(t)) if n >= min_words or (n >= COVERED_WORDS and n >= coverage * automaton.own[k])] if t else []
                    if gone:
                        texts[i] = without_spans(t, gone)
                        spans[i] += len(gone)
                        chars[i] += len(t) - len(texts[i])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans, pa.int32()), pa.array(chars, pa.int32())], ["doc_id", "text", "spans_removed", "chars_removed"])

        out = out.mapInArrow(run, "doc_id long, text string, spans_removed int, chars_removed int")
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the written units of the words in each ``(first, end)``."""
    _, begin, end = located_words(text)
    kept, at = [], 0
    for a, b in sorted((begin[a], max(end[a:b])) for a, b in spans if a < b):
        if a >= at:
            kept.append(text[at:a].rstrip())
        at = max(at, b)
    return " ".join(x for x in (*kept, text[at:].lstrip()) if x)
