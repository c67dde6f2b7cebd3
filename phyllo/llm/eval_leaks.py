"""Evaluation texts that leak into training text, found by template windows and checked by slots.

Texts are canonicalised: markup and entities fall away, case, accents, punctuation and white space don't matter, and
numbers, units and known names become typed placeholders, so that a question whose parameters were exchanged keeps its
template. Windows of ``WINDOW`` template words of all items form a hash table, against which the windows of every document
are joined where the document is read: no shuffle, and the whole text is seen. Where windows of an item lie on neighbouring
diagonals, words are aligned (match, change, left out, added), and the best passage is measured.

A document leaks an item if one passage of it covers at least ``SPAN`` words of the item in order, ``SHARED`` of them equal, and
at least ``DENSITY`` of the passage is shared. Shared are equal words, and slots whose placeholders agree in type and, as the
slot check, whose values are exchanged consistently both ways: one value may not stand for two others, nor two for one.

Up to ``BLOCK`` items the hash table is broadcast. Of more items the windows are hashed and joined by shuffle instead (one row
for each different window of a text), and only the pairs of a document and an item with three windows in common are
aligned; the result is the same, documents are read twice whatever the number of items, and nothing is collected.

Defined results: null, empty and blank texts leak nothing and are never leaked; an item of fewer than ``SPAN`` words can't
leak; repeated document rows give repeated results only if their doc_id differs; empty tables give an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phyllo.functions.text import fold
from phyllo.session import ship

WINDOW, SPAN, SHARED, DENSITY = 3, 13, 11, 0.78
NAMES = 1_000_000
BLOCK, SLACK, CLOSE, EDGE = 20_000, 12, 14, 10
TAG = re.compile(r"<[^<>]{1,300}>")
LINK = re.compile(r"\]\([^()\s]{0,300}\)")
WORD = re.compile(r"[^\W_]+")
#: UTF-8 read as Windows-1252: a lead byte and what its followers become. Fixed values.
MANGLED = re.compile("[\u00c2-\u00f4][\u0080-\u00bf\u20ac\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\u017d\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\u017e\u0178]{1,3}")
#: Units of measure. Fixed values.
UNITS = {"mm", "cm", "dm", "m", "km", "ml", "cl", "dl", "l", "mg", "g", "kg", "c", "s", "min", "h", "in", "ft", "oz", "lb", "ppm", "px"}


def _mended(m: re.Match) -> str:
    raw = b"".join(c.encode("cp1252", "ignore") or c.encode("latin-1", "ignore") for c in m.group())
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m.group()


def tokens(text: str) -> list[str]:
    """The folded words of a text without its markup."""
    s = LINK.sub("] ", TAG.sub(" ", text))
    if "&" in s:
        s = html.unescape(s)
    if "Ã" in s or "Â" in s or "â€" in s:
        s = MANGLED.sub(_mended, s)
    s = s.replace("­", "").replace("​", "")
    return WORD.findall(fold(s))


class Template(dict):
    """word -> word or placeholder, filled as words come; ``names`` stand for names."""

    def __init__(self, names: frozenset[str] = frozenset(), most: int = 1_000_000) -> None:
        self.names, self.most = names, most

    def __missing__(self, w: str) -> str:
        if len(self) >= self.most:
            self.clear()
        self[w] = out = "#" if w[0].isdigit() else "@" if w in self.names else w
        return out

    def of(self, words: list[str]) -> list[str]:
        """Typed placeholders for numbers, units after a number and known names."""
        out = list(map(self.__getitem__, words))
        if "#" in out:
            for i in range(len(out) - 1):
                if out[i] == "#" and words[i + 1] in UNITS:
                    out[i + 1] = "%"
        return out


def template(words: list[str], names: frozenset[str] = frozenset()) -> list[str]:
    return Template(names).of(words)


def align(a: list[str], b: list[str]) -> tuple[float, int, int, int, int, list[tuple[int, int]]]:
    """The best local alignment of item words a and text words b: (score, start and end in a, start and end in b, pairs)."""
    n, m = len(a), len(b)
    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    back = [[0] * (m + 1) for _ in range(n + 1)]
    best, at = 0.0, (0, 0)
    for i in range(1, n + 1):
        x, row, up = a[i - 1], score[i], score[i - 1]
        for j in range(1, m + 1):
            s, k = (up[j - 1] + 1.0, 1) if x == b[j - 1] else (up[j - 1] - 1.0, 1)
            if up[j] - 1.0 > s:
                s, k = up[j] - 1.0, 2
            if row[j - 1] - 1.0 > s:
                s, k = row[j - 1] - 1.0, 3
            if s <= 0:
                continue
            row[j], back[i][j] = s, k
            if s > best:
                best, at = s, (i, j)
    i, j = at
    pairs = []
    while i and j and back[i][j]:
        k = back[i][j]
        if k == 1:
            if a[i - 1] == b[j - 1]:
                pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif k == 2:
            i -= 1
        else:
            j -= 1
    pairs.reverse()
    return best, i, at[0], j, at[1], pairs


class Items:
    """The window table of one block of items: (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]], names: frozenset[str]) -> None:
        self.template, self.words, self.slots, self.windows = Template(names).of, {}, {}, {}
        for item, text in items:
            words = tokens(text or "")
            if len(words) < SPAN:
                continue
            self.slots[item], self.words[item] = words, self.template(words)
            t = self.words[item]
            for i in range(len(t) - WINDOW + 1):
                self.windows.setdefault(tuple(t[i : i + WINDOW]), []).append((item, i))

    def leaks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, shared words, words of the item covered, position in the text) of each item that leaks."""
        raw = tokens(text)
        t = self.template(raw)
        hits: dict[int, list[tuple[int, int]]] = {}
        own = list(zip(*(t[k:] for k in range(WINDOW))))
        met = self.windows.keys() & own
        for j, key in enumerate(own) if met else ():
            if key in met:
                for item, i in self.windows[key]:
                    hits.setdefault(item, []).append((j, i))
        out = []
        for item, at in hits.items():
            if len({i for _, i in at}) < 3:  # 13 words of which two are wrong keep three windows or more
                continue
            found = self._best(item, at, t, raw)
            if found:
                out.append((item, *found))
        return out

    def _best(self, item: int, at: list[tuple[int, int]], t: list[str], raw: list[str]) -> tuple[int, int, int] | None:
        words, best = self.words[item], None
        at.sort(key=lambda x: x[0] - x[1])
        # runs of hits whose diagonals lie close together; a run may be spread over the text, so it is cut into places
        runs: list[list[tuple[int, int]]] = []
        for hit in at:
            if runs and hit[0] - hit[1] - (runs[-1][-1][0] - runs[-1][-1][1]) <= SLACK:
                runs[-1].append(hit)
            else:
                runs.append([hit])
        for run in runs:
            places = sorted(j for j, _ in run)
            # the sparsest passage that counts still has three windows so close together
            if not any(z - x <= CLOSE for x, z in zip(places, places[2:])):
                continue
            first = max(0, min(i for _, i in run) - EDGE)
            part = words[first : max(i for _, i in run) + WINDOW + EDGE]
            low, high = max(0, places[0] - EDGE), min(len(t), places[-1] + WINDOW + EDGE)
            for start in range(low, max(low + 1, high - len(part)), 2 * len(part)):  # pieces overlap by more than the part
                stop = min(high, start + 4 * len(part))
                got = self._measure(item, first, part, t[start:stop], raw[start:stop])
                if got and (best is None or got[0] > best[0]):
                    best = (got[0], got[1], start + got[2])
        return best

    def _measure(self, item: int, first: int, words: list[str], t: list[str], raw: list[str]) -> tuple[int, int, int] | None:
        *_, pairs = align(words, t)
        if len(pairs) < SHARED:
            return None
        there: dict[tuple[str, str], str] = {}  # what stands for a value of the item, and what a value of the text stands for
        back: dict[tuple[str, str], str] = {}
        same, alike = [0], [0]  # running counts of equal words, and of those or slots exchanged consistently
        for i, j in pairs:
            own = self.slots[item][first + i]
            fits = words[i] not in "#%@" or there.setdefault((words[i], own), raw[j]) == raw[j] and back.setdefault((words[i], raw[j]), own) == own
            same.append(same[-1] + (own == raw[j]))
            alike.append(alike[-1] + fits)
        # the longest run of pairs that is dense enough: an alignment may trail off into words that agree by chance
        for n in range(len(pairs), SHARED - 1, -1):
            for x in range(len(pairs) - n + 1):
                (i0, j0), (i1, j1) = pairs[x], pairs[x + n - 1]
                span = i1 - i0 + 1
                if span >= SPAN and same[x + n] - same[x] >= SHARED and alike[x + n] - alike[x] >= DENSITY * max(span, j1 - j0 + 1):
                    return alike[x + n] - alike[x], span, j0
        return None


@lru_cache(maxsize=4096)
def _items(items: tuple, names: frozenset[str]) -> Items:
    return Items(list(items), names)


def _templates(rows: DataFrame, key: str, names: Broadcast) -> DataFrame:
    """(key, h, n): the different windows of each text, hashed, and how often each is in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_of = Template(names.value).of
        for batch in batches:
            words = [made_of(tokens(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=[key, "words"])

    made = rows.select(key, "text").mapInArrow(run, f"{key} long, words array<string>").where(F.size("words") >= WINDOW)
    window = lambda i: F.xxhash64(*[F.element_at("words", i + k) for k in range(WINDOW)])
    windows = F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), window)
    return made.select(key, F.explode(windows).alias("h")).groupBy(key, "h").agg(F.count("*").alias("n"))


def _candidates(docs: DataFrame, asked: DataFrame, names: Broadcast) -> DataFrame:
    """(doc_id, item_id, text, item) of the pairs that have three windows in common."""
    own = _templates(asked, "item_id", names).withColumnRenamed("n", "places")
    met = _templates(docs, "doc_id", names).join(own, "h").groupBy("doc_id", "item_id").agg(F.sum("places").alias("places")).where("places >= 3")
    pairs = met.join(asked.select("item_id", F.col("text").alias("item")), "item_id").withColumnRenamed("doc_id", "d")
    return docs.join(pairs, docs["doc_id"].eqNullSafe(pairs["d"])).select("doc_id", "item_id", "text", "item")


def leaks(documents: DataFrame, items: DataFrame, names: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, shared, covered, position) of every document that holds a passage of an item.

    names: an optional table with a column ``name`` of words that stand for names; it is a dictionary and is broadcast, so
    it may have ``NAMES`` rows at most. block: so many items are broadcast; it does not change the result.
    """
    spark = documents.sparkSession
    known: frozenset[str] = frozenset()
    if names is not None:
        rows = names.select("name").where("name IS NOT NULL").distinct().limit(NAMES + 1).collect()
        if len(rows) > NAMES:
            raise ValueError(f"more than {NAMES} names")
        known = frozenset(w for r in rows for w in WORD.findall(fold(r["name"])))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    ship(spark)
    columns = ["doc_id", "item_id", "shared", "covered", "position"]
    kind = ", ".join(f"{c} long" for c in columns)
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], names=columns)
    few = asked.limit(block + 1).collect()
    if len(few) <= block:
        shared = spark.sparkContext.broadcast((tuple(sorted(map(tuple, few))), known))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _items(*shared.value)
            for batch in batches:
                yield batch_of([(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in table.leaks(text)])

        return docs.mapInArrow(run, kind)
    spread = spark.sparkContext.broadcast(known)

    def align_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "text", "item")))
            yield batch_of([(doc, *hit) for doc, item, text, own in rows for hit in _items(((item, own),), spread.value).leaks(text)])

    return _candidates(docs, asked, spread).mapInArrow(align_pairs, kind)


def leak_report(documents: DataFrame, items: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Each item with the number of documents and of sources that hold a passage of it; 0 where it leaked nowhere."""
    found = leaks(documents, items, names).select("doc_id", "item_id").distinct().join(documents.select("doc_id", "source"), "doc_id")
    counts = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.countDistinct("source").alias("n_sources"))
    zero = F.lit(0).cast("long")
    return items.select("item_id", "split").join(counts, "item_id", "left").select("item_id", "split", F.coalesce("n_documents", zero).alias("n_documents"), F.coalesce("n_sources", zero).alias("n_sources"))
