"""Freely typed names to the entries of a reference list, by a multi-pattern automaton; the unmatched are reported.

1. An Aho-Corasick automaton over all names and aliases (as folded words) finds the mentions embedded in a value; of the
   mentions that overlap the longest wins, and of the rest the longest, then the first.
2. A value without one goes to abbreviations: an initial and an epithet match if just one plant fits; an epithet with wrong
   letters if just one is nearest.
3. What is left goes to token-set similarity: a name is as similar as its words find different words of the value, in any
   order and among any others, each as similar as its edit distance leaves it; up to two wrong letters in all (a swap of
   neighbours is one), for words out of their order one in four. The longest name wins, then the fewest wrong letters,
   then words that stand together; else it is ambiguous. Words like a given one come from an index of all words with up to two letters left out.
   A value whose words don't do it may be broken at wrong blanks: runs of words are compared with whole names,
   blanks not counting, with candidates from a second automaton over the fifths of all names (two wrong letters leave a
   fifth whole).

The score of a match holds all that decides (kind, length, wrong letters, place), so it is the same whatever part of the list
a name is compared with. Up to ``BLOCK`` entries are broadcast, and values are matched where they are. A longer list is cut
into blocks (a genus in one block, as varieties are told from species), the distinct values are cut into slices, and each
pair of a block and a slice is matched in one task by a cogrouped join; nothing is collected, and the table is read once.

Defined results: null, blank and unmatched values give ''; two columns are tried both, the better match wins (whole
mention over abbreviation over similar words over runs), then the first column; names that mean two plants alike match neither (by their
full form), except that a scientific name goes before a synonym; a value that has but one word outside brackets is read with
the bracketed words; repeated rows give repeated results; an empty list leaves all unmatched. Only the named columns are
read, so extra columns can't clash.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phyllo.functions.text import fold
from phyllo.session import ship

BLOCK, SLICE = 20_000, 50_000
#: Bits of a score below the kind of match.
KIND, PLACE = 56, (1 << 28) - 1
#: Ranks, qualifiers and hybrid marks that are no words of a name. Fixed values.
NO_WORD = {
    "x", "cf", "aff", "sp", "spp", "var", "v", "varietas", "subsp", "ssp", "subspecies", "f", "fo", "forma", "form", "subvar", "cv", "cultivar",
    "agg", "nr", "near", "probably", "maybe", "hybrid", "the", "species", "affinis", "confer",
}
QUOTED = re.compile(r"[‘’'ʽʼ‛`´\"“”„«»‹›]([^‘’'ʽʼ‛`´\"“”„«»‹›]*)[‘’'ʽʼ‛`´\"“”„«»‹›]")
BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
CULTIVAR = re.compile(r"\bcv\b\.?.*$", re.S)
LETTERS = re.compile(r"[^\W_]+")


def words(raw: str, bracketed: bool = False) -> list[str]:
    """The folded words of a name: no marks of hybrids, ranks or doubt, no cultivars, no bracketed remarks."""
    s = html.unescape(html.unescape(raw.replace("&TIMES;", "&times;"))).replace("×", " ").replace("✕", " ").replace("_", " ")
    s = fold(s)
    bare = QUOTED.sub(" ", s)
    bare = CULTIVAR.sub(" ", bare if bracketed else BRACKETS.sub(" ", bare))
    found = LETTERS.findall(bare) or LETTERS.findall(s)
    # a first letter is an abbreviated genus, an x only if no genus follows it
    initial = len(found) > 1 and len(found[0]) == 1 and (found[0] != "x" or sum(w not in NO_WORD for w in found) == 1)
    return [w for n, w in enumerate(found) if w not in NO_WORD or (n == 0 and initial)]


def distance(a: str, b: str, most: int) -> int:
    """Edits from a to b, a swap of neighbours being one; most + 1 if there are more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i] + [0] * len(b)
        low, high = max(1, i - most), min(len(b), i + most)
        if low > 1:
            row[low - 1] = most + 1
        for j in range(low, high + 1):
            y = b[j - 1]
            row[j] = min(before[j - 1] + (x != y), row[j - 1] + 1, (before[j] if j < i + most else most + 1) + 1)
            if last and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], last[j - 2] + 1)
        if min(row[low : high + 1]) > most:
            return most + 1
    return min(row[len(b)], most + 1)


def letters(s: str) -> int:
    """The letters of s as a bit set."""
    out = 0
    for c in set(s):
        out |= 1 << (ord(c) & 63)
    return out


def shortened(w: str, most: int) -> set[str]:
    """w with up to ``most`` letters left out: two words within ``most`` edits have one of these in common."""
    out, last = {w}, {w}
    for _ in range(most):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out |= last
    return out


class Matcher:
    """Names of one block of the list: entries (id, scientific name, '|'-joined synonyms)."""

    def __init__(self, entries: list[tuple[str, str | None, str | None]], most: int = 2) -> None:
        self.most = most
        self.whole: dict[tuple[str, ...], tuple[int, set[str]]] = {}
        self.short: dict[str, dict[str, set[str]]] = {}  # initial -> epithet -> ids
        for own, name, synonyms in entries:
            for rank, raw in [(0, name or ""), *((1, s) for s in (synonyms or "").split("|"))]:
                full = tuple(self._name(raw, rank))
                if len(full) < 2:
                    continue
                had = self.whole.get(full)
                if had is None or had[0] > rank:
                    self.whole[full] = (rank, {own})
                elif had[0] == rank:
                    had[1].add(own)
                if len(full) == 2:
                    self.short.setdefault(full[0][0], {}).setdefault(full[1], set()).add(own)
        self.longer: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
        self.holding: dict[str, list[tuple[str, ...]]] = {}  # last word of a name -> names
        self.brief: dict[str, list[str]] = {}  # a shortened word -> words of names
        self.near: dict[str, dict[str, int]] = {}
        for full in self.whole:
            if len(full) == 3:
                self.longer.setdefault(full[:2], []).append(full)
            self.holding.setdefault(full[-1], []).append(full)
        for w in {w for full in self.whole for w in full}:
            for x in shortened(w, most):
                self.brief.setdefault(x, []).append(w)
        self.least = min((sum(map(len, full)) for full in self.whole), default=0)
        self.mentions, self.pieces = ahocorasick.Automaton(), ahocorasick.Automaton()
        fifths: dict[str, dict[int, list[tuple[int, int, tuple[str, ...]]]]] = {}
        for full in self.whole:
            self.mentions.add_word(" " + " ".join(full) + " ", full)
            flat, n = "".join(full), 2 * most + 1
            for k in range(n):
                at = len(flat) * k // n
                piece = flat[at : len(flat) * (k + 1) // n]
                if piece:
                    fifths.setdefault(piece, {}).setdefault(at, []).append((len(flat), letters(flat), full))
        for piece, owners in fifths.items():
            self.pieces.add_word(piece, (len(piece), owners))
        self.mentions.make_automaton()
        self.pieces.make_automaton()

    @staticmethod
    def _name(raw: str, rank: int) -> list[str]:
        """Words of a listed name without its authority: what follows the epithet counts only after a rank."""
        ws = words(raw)
        infra = re.search(r"\b(?:var|subsp|ssp|f|fo|forma|subvar|v)\b\.?\s+\S", fold(html.unescape(raw)))
        return ws[: 3 if infra and len(ws) > 2 else 2]

    def match(self, raw: str | None) -> tuple[int, str, str] | None:
        """(score, id, another id or ''): the higher the score the better; a second id makes it ambiguous."""
        ws = words(raw) if raw and self.whole else []
        if not ws:
            return None
        found = self._mention(ws) or self._abbreviated(ws) or self._tokens(ws) or self._run(ws)
        if found is None and len(ws) == 1 and BRACKETS.search(raw):  # the rest of the name may stand in brackets
            more = words(raw, True)
            if len(more) > 1:
                found = self._mention(more, ws[0]) or self._tokens(more, ws[0])
                return found and (found[0] & (1 << KIND) - 1, *found[1:])
        return found

    @staticmethod
    def _result(kind: int, rest: int, ids: set[str]) -> tuple[int, str, str]:
        two = sorted(ids)[:2]
        return kind << KIND | rest, two[0], two[1] if len(two) > 1 else ""

    def _mention(self, ws: list[str], must: str = "") -> tuple[int, str, str] | None:
        text = " " + " ".join(ws) + " "
        found = [(end - sum(map(len, full)) - len(full) + 1, end, full) for end, full in self.mentions.iter(text) if not must or must in full]
        free: list[tuple[int, int, tuple[str, ...]]] = []
        for start, end, full in sorted(found, key=lambda x: (-len(x[2]), x[0] - x[1], x[0])):
            if all(end <= a or start >= b for a, b, _ in free):
                free.append((start, end, full))
        if not free:
            return None
        low, full = min((((-len(x), start), x) for start, _, full in free for x in (self._below(ws, full) or full,)), key=lambda x: x[0])
        rank, ids = self.whole[full]
        return self._result(4, len(full) << 52 | (PLACE - min(low[1], PLACE)) << 20 | min(sum(map(len, full)), (1 << 19) - 1) << 1 | (1 - rank), ids)

    def _below(self, ws: list[str], full: tuple[str, ...]) -> tuple[str, ...] | None:
        """The variety whose name goes on after a species' name with up to two wrong letters."""
        at = next(i for i in range(len(ws)) if tuple(ws[i : i + len(full)]) == full) + len(full)
        if at >= len(ws):
            return None
        near = sorted((d, own) for own in self.longer.get(full, ()) if (d := distance(ws[at], own[len(full)], self.most)) <= self.most)
        return near[0][1] if near and (len(near) == 1 or near[0][0] < near[1][0]) else None

    def _abbreviated(self, ws: list[str]) -> tuple[int, str, str] | None:
        best: tuple[int, int] | None = None
        ids: set[str] = set()
        for i, (a, b) in enumerate(zip(ws, ws[1:])):
            own = self.short.get(a) if len(a) == 1 else None
            if not own:
                continue
            # a short word after an initial further on is an author
            near = {b: 0} if b in own else {e: d for e in own if (i == 0 or len(b) >= 6) and (d := distance(e, b, self.most)) <= self.most}
            for e, d in near.items():
                if best is None or (d, i) < best:
                    best, ids = (d, i), set()
                if (d, i) == best:
                    ids |= own[e]
        return self._result(3, (self.most - best[0]) << 28 | PLACE - min(best[1], PLACE), ids) if best else None

    def _alike(self, w: str) -> dict[str, int]:
        """The words of names within ``most`` wrong letters of w, and how many they are."""
        got = self.near.get(w)
        if got is None:
            if len(self.near) > 100_000:
                self.near.clear()
            met = {x for s in shortened(w, self.most) for x in self.brief.get(s, ())} if len(w) <= 40 else ()
            got = self.near[w] = {x: d for x in met if (d := distance(x, w, self.most)) <= self.most}
        return got

    def _tokens(self, ws: list[str], must: str = "") -> tuple[int, str, str] | None:
        """The names whose words all find different words of the value; ``must``: one word of the value that has to serve."""
        places: dict[str, list[tuple[int, int]]] = {}  # word of a name -> (wrong letters, place in the value)
        for i, w in enumerate(ws):
            for x, d in self._alike(w).items():
                places.setdefault(x, []).append((d, i))
        best: tuple[int, int, int] = (0, 0, 0)
        ids: set[str] = set()
        for last in places:
            for full in self.holding.get(last, ()):
                if len(full) < best[0] or not all(x in places for x in full):
                    continue
                got = self._assign([places[x] for x in full], ws, ws.index(must) if must else None)
                if got is None:
                    continue
                key = (len(full), self.most - got[0], got[1])
                if key > best:
                    best, ids = key, set()
                if key == best:
                    ids |= self.whole[full][1]
        return self._result(2, best[0] << 40 | best[1] << 8 | best[2], ids) if ids else None

    def _assign(self, places: list[list[tuple[int, int]]], ws: list[str], must: int | None) -> tuple[int, int] | None:
        """(fewest wrong letters, 1 if the words stand together in order) of different places for each word of a name."""
        best: tuple[int, int] | None = None

        def go(k: int, wrong: int, taken: tuple[int, ...]) -> None:
            nonlocal best
            if wrong > self.most:
                return
            if k == len(places):
                if must is not None and must not in taken:
                    return
                together = all(b == a + 1 for a, b in zip(taken, taken[1:]))
                if together or all(4 * d <= len(ws[i]) for at, i in zip(places, taken) for d in (next(d for d, j in at if j == i),)):
                    found = (wrong, -int(together))
                    if best is None or found < best:
                        best = found
                return
            for d, i in places[k]:
                if i not in taken:
                    go(k + 1, wrong + d, (*taken, i))

        go(0, 0, ())
        return (best[0], -best[1]) if best else None

    def _run(self, ws: list[str]) -> tuple[int, str, str] | None:
        """The names that a run of words spells, whatever its blanks."""
        flat, bounds = "".join(ws), [0]
        if len(flat) < self.least - self.most:
            return None
        for w in ws:
            bounds.append(bounds[-1] + len(w))
        wrong = 2 * self.most  # a wrong letter takes one letter away and brings another at most
        starts, ends = set(bounds[:-1]), set(bounds)
        held: dict[tuple[int, int], int] = {}  # the letters of the runs looked at
        runs: set[tuple[tuple[str, ...], int, int]] = set()
        for end, (size, owners) in self.pieces.iter(flat):
            for at, names in owners.items():
                # the name would start here: at a word, give or take the wrong letters before the piece, and end at one
                near = end - size + 1 - at
                for b in range(max(0, near - self.most), near + self.most + 1):
                    if b not in starts:
                        continue
                    for n, own, full in names:
                        for e in range(b + n - self.most, b + n + self.most + 1):
                            if e not in ends:
                                continue
                            has = held.get((b, e))
                            if has is None:
                                has = held[b, e] = letters(flat[b:e])
                            if (own ^ has).bit_count() <= wrong:
                                runs.add((full, b, e))
        best, ids = (0, 0), set()
        for full, b, e in runs:
            if len(full) < best[0]:
                continue
            d = distance(flat[b:e], "".join(full), self.most)
            key = (len(full), self.most - d)
            if d <= self.most and key > best:
                best, ids = key, set()
            if d <= self.most and key == best:
                ids |= self.whole[full][1]
        return self._result(1, best[0] << 40 | best[1] << 8, ids) if ids else None


@lru_cache(maxsize=2)
def _matcher(entries: tuple) -> Matcher:
    return Matcher(list(entries))


def _broadcast_matches(answers: DataFrame, listed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(k, c, score, id, other): each value that matches, where it is; listed has ``BLOCK`` entries at most."""
    shared = answers.sparkSession.sparkContext.broadcast(tuple(sorted(map(tuple, listed.collect()), key=repr)))
    kind = answers.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared.value)
        seen: dict[str, tuple | None] = {}
        for batch in batches:
            out: list[tuple] = []
            values = [batch.column(c).to_pylist() for c in columns]
            for at, k in enumerate(batch.column(key).to_pylist()):
                for c, column in enumerate(values):
                    v = column[at]
                    if v is None:
                        continue
                    if v not in seen:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen[v] = matcher.match(v)
                    if seen[v]:
                        out.append((k, c, *seen[v]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], batch.schema.field(key).type), *(pa.array([x[n] for x in out], t) for n, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.string()), (4, pa.string())))],
                names=["k", "c", "score", "id", "other"],
            )

    return answers.select(key, *columns).mapInArrow(run, f"k {kind}, c int, score long, id string, other string")


def _joined_matches(values: DataFrame, listed: DataFrame, blocks: int, slices: int) -> DataFrame:
    """(value, score, id, other): distinct values against a list of any length, a block and a slice a task."""
    none = F.lit(None).cast("string")
    synonyms = F.transform(F.split(F.coalesce("synonyms", F.lit("")), r"\|"), lambda s: F.struct(none.alias("scientific_name"), s.alias("synonyms")))
    forms = F.concat(F.array(F.struct(F.col("scientific_name"), none.alias("synonyms"))), synonyms)
    genus = F.regexp_extract(F.lower(F.coalesce("scientific_name", "synonyms")), r"\p{L}{2,}", 0)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    names = listed.select("internal_id", F.inline(forms)).withColumn("b", F.pmod(F.xxhash64(genus), F.lit(blocks)).cast("int")).withColumn("s", every(slices))
    asked = values.withColumn("s", F.pmod(F.xxhash64("value"), F.lit(slices)).cast("int")).withColumn("b", every(blocks))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        matcher = Matcher([tuple(None if x is None or x != x else x for x in r) for r in right[["internal_id", "scientific_name", "synonyms"]].itertuples(index=False)])
        found = [(v, *m) for v in left["value"] if (m := matcher.match(v))]
        return pd.DataFrame(found, columns=["value", "score", "id", "other"])

    return asked.groupBy("b", "s").cogroup(names.groupBy("b", "s")).applyInPandas(one, "value string, score long, id string, other string")


def match_names(answers: DataFrame, plants: DataFrame, key: str = "answer_id", columns: tuple[str, ...] = ("matched_as", "canonical_name"), block: int = BLOCK, piece: int = SLICE) -> DataFrame:
    """(key, internal_id) of every row of answers; internal_id is '' where no entry of plants is meant.

    ``block``: entries of the list, and ``piece``: distinct values, that one task takes; they don't change the result.
    """
    ship(answers.sparkSession)
    listed = plants.select("internal_id", "scientific_name", "synonyms").where("internal_id IS NOT NULL")
    blocks = max(1, -(-listed.count() // block))
    if blocks == 1:
        found = _broadcast_matches(answers, listed, key, list(columns))
    else:
        asked = answers.select(F.col(key).alias("k"), F.posexplode(F.array(*[F.col(c) for c in columns])).alias("c", "value")).where("value IS NOT NULL")
        values = asked.select("value").distinct()
        found = asked.join(_joined_matches(values, listed, blocks, max(1, -(-values.count() // piece))), "value").drop("value")
    # per column the best score, and whether it means one plant only; then the better column
    per = found.groupBy("k", "c").agg(F.max("score").alias("top"), F.collect_set(F.struct("score", "id", "other")).alias("all"))
    ids = F.array_distinct(F.flatten(F.transform(F.filter("all", lambda x: x["score"] == F.col("top")), lambda x: F.array(x["id"], x["other"]))))
    per = per.withColumn("ids", F.array_remove(ids, "")).where(F.size("ids") == 1)
    best = per.groupBy("k").agg(F.max(F.struct(F.shiftright("top", KIND).alias("kind"), (-F.col("c")).alias("first"), F.col("ids")[0].alias("id"))).alias("best"))
    return answers.select(key).join(best, answers[key] == best["k"], "left").select(key, F.coalesce("best.id", F.lit("")).alias("internal_id"))


def unmatched(answers: DataFrame, plants: DataFrame, key: str = "answer_id", columns: tuple[str, ...] = ("matched_as", "canonical_name")) -> DataFrame:
    """The unmatched values and how many answers hold each, in either column."""
    bare = match_names(answers, plants, key, columns).where("internal_id = ''").select(key)
    values = F.explode(F.array(*[F.col(c) for c in columns])).alias("value")
    return answers.join(bare, key, "left_semi").select(key, values).where("value IS NOT NULL").groupBy("value").agg(F.countDistinct(key).alias("n_answers"))
