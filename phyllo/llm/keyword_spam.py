"""Keyword-stuffed and link-list pages: recurrence gaps, positional autocorrelation and lists without function words.

A text is cut into links, tags and units (lines, sentences, list members). Links, hash tags and units with prices or article
numbers are stuffing by themselves; records of a log are not. The words of all other units, in their order, are judged by
lag windows:

* Repetition. A word recurs if the same word stands at most ``LAGS`` words away. Around each word, the share of content
  words that recur and the share of words that return at one and the same lag (positional autocorrelation) are taken;
  prose does not reach ``DENSE`` and ``REGULAR``, whatever its language. Function words don't excuse repetition.
* Lists. A unit whose words mostly have no two different function words within ``NEAR`` places (one may belong to a
  keyword; a core one, such as an article, suffices) is a list of nouns in place of a sentence, unless it is shaped like a
  sentence: ``SHAPED`` to ``LONG`` words, an end mark, a comma after every third word at most. So prose of languages that
  nothing is known about stays.

Which words are function words is learned from the corpus, of each language: those that stand in at least ``COMMON`` of the
sentences (``CORE``: the core ones), averaged over the documents, so that a word must be frequent and evenly spread to get
there. One aggregation over all texts with map-side combine finds them; at most some hundred words a language are collected,
since the shares of one sentence's words sum to its length. A language with fewer than ``LEAST`` documents isn't learned.
As a text may hold several languages, each stretch of ``SPAN`` words is measured by the language that knows most of them.

A page is flagged if more than half of its characters are stuffing. Every text is measured whole, without a shuffle.
Defined results: null, empty and blank texts and texts without words are not flagged; repeated rows give repeated results;
a table without the column lang is one of unknown languages; tables may have other columns.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.session import materialize, release, ship

NEAR, LAGS, SPAN, HALF = 6, 12, 12, 0.5
DENSE, REGULAR = 0.7, 0.5
COMMON, CORE, LEAST, SHAPED, LONG = 0.06, 0.3, 30, 5, 60
LINK = re.compile(r"<a\b[^<>]*>(.*?)</a>|\[([^\[\]\n]{0,200})\]\(\s*(?:https?://|www\.)[^()\s]*\s*\)|(?:https?://|www\.)[^\s<>()\"']+", re.I | re.S)
TAG = re.compile(r"<[^<>]{1,300}>")
HASH = re.compile(r"(?<![\w&/])#[^\W\d_]\w*")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
PRICE = re.compile(r"\d+(?:[.,]\d{2})?\s?(?:EUR|USD|GBP|CHF|€|\$|£)(?!\w)|(?:€|\$|£|EUR|USD|GBP|CHF)\s?\d|\b(?:SKU|EAN|GTIN|ASIN|MPN|REF|ART)[-:# ]?\s?[A-Z0-9-]*\d{3,}", re.I)
RECORD = re.compile(r"^\W{0,3}(?:\[\d+(?:/\d+)?\]|\d{4}-\d\d-\d\d|\d\d:\d\d)|\b\w+:\s*\d+\b.*\d|\(\w+ \d+")
DIGIT = re.compile(r"\d")
#: Latin, Greek and Cyrillic small letters, with which no sentence begins. Fixed values.
SMALL = "a-zß-öø-ÿα-ωа-я"
UNIT = re.compile(rf"\n+|(?<=[.!?…])\s+(?![{SMALL}])|\s[·•|»]+\s|\s>>\s|(?<=;)\s+")
END = re.compile(r"[.!?…;。！？]\W*$")
#: In the JVM: markup, where a sentence ends, its end marks, and what lies between words. Elided words are split.
JVM_TAG, JVM_END, MARKS, JVM_REST = r"<[^<>]{1,300}>", r"(?<=[.!?…])|[\n;]", [".", "!", "?", "…"], r"[^\p{L}\p{M}]+"


def _language(c: Column) -> Column:
    """The first two or three letters of a declared language in lower case; '' for null, und and anything else."""
    code = F.regexp_extract(F.lower(F.trim(c)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.coalesce(F.when(code != "und", code), F.lit(""))


def _declared(documents: DataFrame) -> Column:
    return _language(F.col("lang").cast("string")) if "lang" in documents.columns else F.lit("")


def function_words(documents: DataFrame) -> DataFrame:
    """(lang, word, share): the words that stand in at least COMMON of the sentences of a language with LEAST documents.

    share is the mean over the documents of the share of their sentences that hold the word. A sentence is a unit of
    SHAPED to LONG words with an end mark. The texts are read once: the row of the word '' counts the documents.
    """
    low = F.lower("text")
    text = F.when(F.contains(low, F.lit("<")), F.regexp_replace(low, JVM_TAG, " ")).otherwise(low)
    ends = F.filter(F.split(text, JVM_END), lambda u: F.right(u, F.lit(1)).isin(*MARKS))
    words = F.transform(ends, lambda u: F.split(u, JVM_REST))
    units = F.transform(F.filter(words, lambda w: F.size(w).between(SHAPED + 1, LONG + 1)), lambda w: F.array_distinct(w))
    item = lambda word, weight: F.struct(word.alias("word"), weight.alias("weight"))
    weighed = lambda u: F.concat(F.array(item(F.lit(""), F.lit(1.0))), F.transform(F.filter(F.flatten(u), lambda w: w != ""), lambda w: item(w, 1.0 / F.size(u))))
    # within one expression, or the optimizer would cut each text once for every use of its units
    items = F.flatten(F.transform(F.filter(F.array(units), lambda u: F.size(u) > 0), weighed))
    each = documents.select(_declared(documents).alias("lang"), "text").where("lang <> ''").select("lang", F.explode(items).alias("x"))
    mean = materialize(each.groupBy("lang", F.col("x.word").alias("word")).agg(F.sum("x.weight").alias("w")), "shares")  # read twice
    total = mean.where("word = ''").select("lang", F.col("w").alias("n")).where(F.col("n") >= LEAST)
    shares = mean.where("word <> ''").join(F.broadcast(total), "lang")  # a row a language
    out = shares.where(F.col("w") >= COMMON * F.col("n")).select("lang", "word", (F.col("w") / F.col("n")).alias("share"))
    out._phyllo_path = mean._phyllo_path  # released with it
    return out


class Learned:
    """The function words of the learned languages: {language: {word: core}}."""

    def __init__(self, languages: dict[str, dict[str, bool]]) -> None:
        self.languages = languages
        self.order = sorted(languages)

    def marks(self, ids: dict[str, int]) -> np.ndarray:
        """A row a word, a column a language: 0, 1 for a function word, 2 for a core one."""
        out = np.zeros((len(ids), max(1, len(self.order))), np.int8)
        elided = [(i, re.split("['’]", w)) for w, i in ids.items() if "'" in w or "’" in w]  # their parts were learned apart
        for k, lang in enumerate(self.order):
            own = self.languages[lang]
            for word, core in own.items():
                if (i := ids.get(word)) is not None:
                    out[i, k] = 1 + core
            for i, parts in elided:
                out[i, k] = max((1 + own[p] for p in parts if p in own), default=0)
        return out


def _size(s: str) -> int:
    """Characters that are no white space."""
    return len("".join(s.split()))


class Batch:
    """The plain words of many texts one after another, with their units, measured whole columns at a time."""

    def __init__(self, learned: Learned) -> None:
        self.learned = learned
        self.ids: dict[str, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.word: list[int] = []  # of each word its id
        self.per_unit: list[tuple[int, int, bool, int]] = []  # of each plain unit: words, size, may be a list, text
        self.per_text: list[tuple[int, int, int, str]] = []  # of each text: its size, what is stuffing by itself, links and tags, language

    def add(self, text: str, lang: str = "") -> None:
        s = html.unescape(text) if "&" in text else text
        linked = 0

        def weigh(m: re.Match) -> str:
            nonlocal linked
            linked += _size(m.group())
            return " "

        s = LINK.sub(weigh, s)
        if "<" in s:
            s = TAG.sub("\n", s)
        if "#" in s:
            linked += sum(map(len, HASH.findall(s)))
            s = HASH.sub(" ", s)
        total = stuffed = linked
        at, known = len(self.per_text), self.ids.__getitem__
        for u in UNIT.split(s):
            size = _size(u) if u else 0
            if not size:
                continue
            total += size
            if DIGIT.search(u):
                if PRICE.search(u):
                    stuffed += size
                    continue
                if RECORD.search(u):
                    continue
            ws = WORD.findall(u.casefold())
            shaped = SHAPED <= len(ws) <= LONG and 3 * u.count(",") <= len(ws) and END.search(u) is not None
            self.per_unit.append((len(ws), size, not shaped, at))
            self.word += map(known, ws)
        self.per_text.append((total, stuffed, linked, lang))

    def _marks(self, word: np.ndarray, words: np.ndarray, unit: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Of each word: 0, 1 for a function word, 2 for a core one, by the language that knows most of the SPAN words it is in."""
        every = self.learned.marks(self.ids)
        inner = np.arange(len(word)) - np.r_[0, np.cumsum(words)[:-1]][unit]
        starts = np.flatnonzero(inner % SPAN == 0)
        known = np.add.reduceat(every[word] > 0, starts, axis=0, dtype=np.float64)
        place = {lang: k for k, lang in enumerate(self.learned.order)}
        declared = np.array([place.get(t[3], -1) for t in self.per_text])[of[starts]]
        rows = np.flatnonzero(declared >= 0)
        known[rows, declared[rows]] += 0.5  # of equal ones the declared language
        return every[word, np.repeat(known.argmax(1), np.diff(np.r_[starts, len(word)]))]

    def measures(self) -> np.ndarray:
        """A row a text: (share of stuffing, share of links and tags, recurrence, autocorrelation)."""
        n, texts = len(self.word), len(self.per_text)
        size, alone, linked = (np.array([t[k] for t in self.per_text], np.float64) for k in range(3))
        out = np.zeros((texts, 4))
        some = np.maximum(size, 1)
        if n:
            words, unit_size, may, text = (np.array([u[k] for u in self.per_unit]) for k in range(4))
            unit = np.repeat(np.arange(len(words)), words)
            of = text[unit]
            word = np.array(self.word)
            mark = self._marks(word, words, unit, of)
            edges = np.searchsorted(of, np.arange(texts + 1))
            first, last = edges[of], edges[of + 1]
            key = of * (len(self.ids) + 1) + word
            before = self._before(key)
            repeated, near, auto = self._repeated(key, before, mark, first, last)
            listed = self._bare(mark, before, first, last)
            hits = lambda x: np.bincount(unit, x, len(words))
            bad = (words > 0) & ((2 * hits(repeated) > words) | (may.astype(bool) & (2 * hits(listed) > words)))
            # a unit or two of a text that reads as prose otherwise is a heading or a caption, no list
            enough = np.bincount(text, np.where(bad, words, 0), texts) >= 8
            alone = alone + np.bincount(text, np.where(bad, unit_size, 0), texts) * enough
            counts = np.maximum(np.bincount(of, minlength=texts), 1)
            out[:, 2], out[:, 3] = np.bincount(of, near, texts) / counts, np.bincount(of, auto, texts) / counts
        out[:, 0], out[:, 1] = alone / some, linked / some
        return out

    @staticmethod
    def _before(key: np.ndarray) -> np.ndarray:
        """The place of the same word before, in the same text; far below all places if there is none."""
        order = np.argsort(key, kind="stable")
        out = np.full(len(key), -(1 << 40), np.int64)
        same = key[order[1:]] == key[order[:-1]]
        out[order[1:][same]] = order[:-1][same]
        return out

    @staticmethod
    def _repeated(key: np.ndarray, before: np.ndarray, mark: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: stands it in regular repetition, the share that recurs around it, the best share at one lag."""
        n = len(key)
        at = np.arange(n)
        low, high = np.maximum(at - SPAN, first), np.minimum(at + SPAN + 1, last)

        def around(x: np.ndarray) -> np.ndarray:
            sums = np.r_[0, np.cumsum(x, dtype=np.int64)]
            return sums[high] - sums[low]

        close = at - before <= LAGS
        recurs = close.copy()
        recurs[before[close]] = True
        content = mark == 0
        near = around(recurs & content) / np.maximum(around(content), 1)
        best = np.zeros(n)
        for lag in range(1, min(LAGS, n - 1) + 1):
            equal = np.zeros(n, bool)
            equal[lag:] = key[lag:] == key[:-lag]
            equal[:-lag] |= equal[lag:]
            best = np.maximum(best, around(equal))
        best /= high - low
        return (high - low >= SPAN) & ((near >= DENSE) & (best >= REGULAR)), near, best

    @staticmethod
    def _bare(mark: np.ndarray, before: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of each word: are there neither two different function words nor a core one within NEAR places."""
        n = len(mark)
        at = np.arange(n)
        low, high = np.maximum(at - NEAR, first), np.minimum(at + NEAR + 1, last)
        seen = np.zeros(n, np.int16)
        for d in range(-NEAR, NEAR + 1):
            j = np.clip(at + d, 0, n - 1)
            inside = (at + d >= low) & (at + d < high)
            seen += np.where(inside & (before[j] < low), mark[j], 0).astype(np.int16)
        return seen < 2


def stuffing(text: str, lang: str = "", learned: Learned | None = None) -> tuple[float, float, float, float]:
    """(share of stuffing, share of links and tags, recurrence within LAGS, autocorrelation) of a text, by characters."""
    batch = Batch(learned or Learned({}))
    batch.add(text, lang)
    return tuple(batch.measures()[0].tolist())


def learn(documents: DataFrame) -> Learned:
    """The function words of a corpus; each language has some hundred at most."""
    languages: dict[str, dict[str, bool]] = {}
    found = function_words(documents)
    for r in found.collect():
        languages.setdefault(r["lang"], {})[r["word"]] = r["share"] >= CORE
    release(found)
    return Learned(languages)


def measure(documents: DataFrame, learned: Learned | None = None) -> DataFrame:
    """(doc_id, stuffed, linked, recurrence, autocorrelation) of every document with a text."""
    shared = documents.sparkSession.sparkContext.broadcast((learned or learn(documents)).languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Learned(shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                part, batch = whole.slice(start, 2000), Batch(known)
                for text, lang in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    batch.add(text, lang)
                got = batch.measures()
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[:, k]) for k in range(4))], names=["doc_id", "stuffed", "linked", "recurrence", "autocorrelation"])

    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text", _declared(documents).alias("lang")).where("text IS NOT NULL")
    return rows.mapInArrow(run, f"doc_id {kind}, stuffed double, linked double, recurrence double, autocorrelation double")


def spam(documents: DataFrame, learned: Learned | None = None) -> DataFrame:
    """(doc_id, stuffed) of the documents more than half of whose text is stuffing."""
    return measure(documents, learned).where(F.col("stuffed") > HALF).select("doc_id", "stuffed")
