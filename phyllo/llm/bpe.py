"""Encoding a corpus with a public byte-level BPE: higher-order functions fold ranked merges over distinct words.

1. The tokenizer's own pattern cuts every text into words, in the JVM. 2. Only the distinct words are encoded: their bytes
become ids and ``aggregate`` folds the merges over the id array, the lowest rank first, leftmost first, until none is left.
The ranks are a literal map, laid out as a perfect hash in plain arrays in one row that is broadcast to chunks of words (a
Spark map of 50,000 entries would be searched from its start each time); its size is that of the vocabulary, whatever the
corpus. After a merge only the two pairs beside it are looked up again. The fold rewrites the array at each merge, which is
quadratic in the length of a word; the few distinct words of more than ``LONG`` bytes (endless letters, base64) are merged by
a linked list and a heap in Arrow batches instead. So are all words under a vocabulary too large for the arrays. 3. The words of all texts are joined with their
ids: a bounded number of the commonest words by broadcast, where the texts are, the others by shuffle.

Vocabularies are ``.tiktoken`` files, whose path is a parameter; nothing of them is kept here.

Defined results: a null or empty text has an empty list of ids; strings of special tokens are ordinary text; every row
gives one row, repeated rows too; a text of one endless word is encoded as any other; an empty table gives an empty table;
ids that the vocabulary lacks decode to nothing, and bytes that are no UTF-8 to replacement characters.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.util import find_spec

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.session import materialize, release, ship

#: The white space of Unicode, and the word pattern of the public vocabulary with it. Fixed values.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
CHUNK = 2000
#: Words of more bytes are merged by a heap; a vocabulary of more tokens does not fit the arrays.
LONG, MOST = 256, 60_000
#: So many of the commonest words are broadcast.
FREQUENT = 50_000
#: So many pieces are concatenated before they are joined to what there is.
RUN = 256
NO = 1 << 30
GROUPS, SLOTS, M1, M2 = 1 << 15, 1 << 18, 1640531527, 1103515245


def vocabulary(name: str = "byte_bpe_50k") -> str:
    """The path of a public vocabulary: $PHYLLO_TOKENIZERS, else the installed package of public tokenizers."""
    own = os.environ.get("PHYLLO_TOKENIZERS")
    if not own:
        spec = find_spec("public_tokenizers")
        own = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return f"{own}/{name}.tiktoken"


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def rank_arrays(path: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """(ids of the bytes, displacements, keys, values): the pairs of ids that merge, as a perfect hash of pair to merged id.

    key = left * 65536 + right; group = (key * M1 >> 22) mod GROUPS; slot = (key * (M2 + 2 * displacement) >> 22) mod SLOTS.
    """
    ranks = read_ranks(path)
    if len(ranks) > MOST:
        raise ValueError("the vocabulary is too large for these arrays")
    merges = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                merges[a * 65536 + b] = rank
    groups: dict[int, list[int]] = {}
    for key in merges:
        groups.setdefault((key * M1 >> 22) % GROUPS, []).append(key)
    moved, keys, values = [0] * GROUPS, [-1] * SLOTS, [NO] * SLOTS
    for g, own in sorted(groups.items(), key=lambda x: -len(x[1])):
        d = 0
        while len(at := {(key * (M2 + 2 * d) >> 22) % SLOTS: key for key in own}) < len(own) or any(keys[x] >= 0 for x in at):
            d += 1
            if d > SLOTS:
                raise ValueError("no perfect hash found")
        moved[g] = d
        for x, key in at.items():
            keys[x], values[x] = key, merges[key]
    return [ranks[bytes([i])] for i in range(256)], moved, keys, values


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value computed once."""
    return F.transform(F.array(value), use)[0]


def encode_word(word: Column, first: Column, moved: Column, keys: Column, values: Column) -> Column:
    """The ids of one word, folded merge by merge; the other columns are the arrays of ``rank_arrays``."""

    def rank(a: Column, b: Column) -> Column:
        key = a.cast("long") * 65536 + b

        def at(k: Column) -> Column:
            group = F.shiftright(k * M1, 22) % GROUPS
            slot = F.shiftright(k * (moved[group.cast("int")] * F.lit(2).cast("long") + M2), 22) % SLOTS
            return _let(slot.cast("int"), lambda s: F.when(keys[s] == k, values[s]).otherwise(F.lit(NO)))

        return _let(key, at)

    digits = F.hex(F.encode(word, "utf-8"))
    ids = F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda i: first[F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int")])
    start = _let(ids, lambda x: F.struct(x.alias("ids"), F.when(F.size(x) > 1, F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: rank(x[i - 1], x[i]))).otherwise(F.array().cast("array<int>")).alias("ranks")))

    def step(s: Column, _: Column) -> Column:
        def merge(best: Column) -> Column:
            def at(p: Column) -> Column:  # the pair (p, p + 1), from 1, becomes one id
                left = F.when(p > 1, F.array(rank(s["ids"][p - 2], best))).otherwise(F.array().cast("array<int>"))
                right = F.when(p + 1 < F.size(s["ids"]), F.array(rank(best, s["ids"][p + 1]))).otherwise(F.array().cast("array<int>"))
                ids = F.concat(F.slice(s["ids"], 1, p - 1), F.array(best), F.slice(s["ids"], p + 2, F.size(s["ids"])))
                ranks = F.concat(F.slice(s["ranks"], 1, F.greatest(p - 2, F.lit(0))), left, right, F.slice(s["ranks"], p + 2, F.size(s["ids"])))
                return F.struct(ids.alias("ids"), ranks.alias("ranks"))

            return F.when(best < NO, _let(F.array_position(s["ranks"], best).cast("int"), at)).otherwise(s)

        return _let(F.coalesce(F.array_min(s["ranks"]), F.lit(NO)), merge)

    kind = "struct<ids:array<int>,ranks:array<int>>"
    return F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), start.cast(kind), lambda s, i: step(s, i).cast(kind), lambda s: s["ids"])


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the pair of lowest rank merges first, the leftmost of equals; n log n for n bytes."""
    n = len(word)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left = parts[i]
        j = after[i]
        if left is None or j >= n or len(left) + len(parts[j]) != size:  # merged meanwhile
            continue
        parts[i] = whole = left + parts[j]
        parts[j] = None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(whole + parts[k])) is not None:
                heapq.heappush(heap, (r, i, size + len(parts[k])))
        h = before[i]
        if h >= 0 and (r := ranks.get(parts[h] + whole)) is not None:
            heapq.heappush(heap, (r, h, len(parts[h]) + size))
    return [ranks[p] for p in parts if p is not None]


def _merge_long(words: DataFrame, path: str) -> DataFrame:
    """(word, ids) by ``merge_bytes``; the vocabulary is broadcast."""
    shared = words.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [merge_bytes(w.encode("utf-8"), shared.value) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    ship(words.sparkSession)
    return words.select("word").mapInArrow(run, "word string, ids array<int>")


def words_of(text: Column | str, pattern: str = PATTERN) -> Column:
    return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(pattern), F.lit(0))


def _rank_row(spark: SparkSession, path: str) -> DataFrame:
    first, moved, keys, values = rank_arrays(path)
    return spark.createDataFrame([(0, first, moved, keys, values)], "one int, first array<int>, moved array<int>, keys array<long>, vals array<int>")


def encode_vocabulary(words: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(word, ids) of a table of distinct words (column word)."""
    if len(read_ranks(path)) > MOST:
        return _merge_long(words, path)
    long, words = words.where(F.octet_length("word") > LONG), words.where(F.octet_length("word") <= LONG)
    n = max(1, -(-words.count() // chunk))
    parts = min(n, 4 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, but much work: not to be coalesced
    chunked = words.select("word", F.pmod(F.xxhash64("word"), F.lit(n)).alias("chunk")).repartition(parts, "chunk")
    chunks = chunked.groupBy("chunk").agg(F.collect_list("word").alias("words")).withColumn("one", F.least("chunk", F.lit(0)).cast("int"))
    both = chunks.join(F.broadcast(_rank_row(words.sparkSession, path)), "one")
    ids = F.transform("words", lambda w: F.struct(w.alias("word"), encode_word(w, F.col("first"), F.col("moved"), F.col("keys"), F.col("vals")).alias("ids")))
    return both.select(F.inline(ids)).unionByName(_merge_long(long, path))


def _look_up(words: pa.ListArray, known: pa.Array, starts: np.ndarray, flat: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """(ids, rare) of each row: ids of the known words, the j-th other word of a row as -j, and those other words."""
    at = words.offsets.to_numpy().astype(np.int64)
    own = words.values.slice(at[0], at[-1] - at[0])
    at -= at[0]
    idx = pc.index_in(own, value_set=known).to_numpy(zero_copy_only=False)
    rare = np.isnan(idx) if idx.dtype.kind == "f" else np.zeros(len(idx), bool)
    idx = np.where(rare, 0, idx).astype(np.int64)
    n = np.where(rare, 1, starts[idx + 1] - starts[idx])
    to = np.r_[0, np.cumsum(n)]
    out = np.empty(to[-1], np.int32)
    inner = np.arange(to[-1]) - np.repeat(to[:-1], n)
    out[:] = flat[np.minimum(np.repeat(starts[idx], n) + inner, len(flat) - 1)] if len(flat) else 0
    seen = np.r_[0, np.cumsum(rare)]
    row = np.searchsorted(at, np.flatnonzero(rare), side="right") - 1
    out[to[:-1][rare]] = -(seen[1:][rare] - seen[at[row]])
    return pa.ListArray.from_arrays(pa.array(to[at].astype(np.int32)), pa.array(out)), pa.ListArray.from_arrays(pa.array(seen[at].astype(np.int32)), own.filter(pa.array(rare)))


def encode(documents: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT, pattern: str = PATTERN) -> DataFrame:
    """(key, ids) of every row of documents; pattern: how the vocabulary cuts texts into words, as a Java pattern that takes every character.

    The ``frequent`` commonest words (of 32 characters at most, so a few MB) are broadcast and looked up where the text is;
    only the other words are shuffled to their ids, and only the rows that hold one wait for them.
    """
    path = path or vocabulary()
    words = documents.select(F.explode(words_of(text, pattern)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(words, "words")
    encoded = materialize(encode_vocabulary(words.select("word"), path), "encoded")
    short = encoded.join(words, "word").where(F.length("word") <= 32).orderBy(F.desc("n"), "word").limit(frequent).select("word", "ids").collect()
    release(words)
    shared = documents.sparkSession.sparkContext.broadcast((pa.array([r["word"] for r in short], pa.string()), np.cumsum([0, *(len(r["ids"]) for r in short)]), np.array([i for r in short for i in r["ids"]], np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, starts, flat = shared.value
        for batch in batches:
            column = batch.column("words")
            if batch.num_rows and len(known):
                ids, rare = _look_up(column, known, starts, flat)
            else:  # no word is known: each row is all rare
                n = np.diff(column.offsets.to_numpy())
                ids, rare = pa.ListArray.from_arrays(column.offsets, pa.array(-np.concatenate([np.arange(1, k + 1) for k in n] or [[]]).astype(np.int32))), column
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("key"), ids, rare], names=["row", "key", "ids", "rare"])

    # rows are told apart by their place in the scan, so repeated keys or rows don't run together
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(words_of(text, pattern), F.array().cast("array<string>")).alias("words"))
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    placed = materialize(rows.mapInArrow(run, f"row long, key {kind}, ids array<int>, rare array<string>"), "placed")
    done = placed.where(F.size("rare") == 0).select(F.col("key").alias(key), "ids")
    open_ = placed.where(F.size("rare") > 0)
    found = open_.select("row", F.posexplode("rare").alias("j", "word")).join(encoded.withColumnRenamed("ids", "own"), "word")
    found = found.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "own"))), lambda x: x["own"]).alias("own"))
    filled = F.flatten(F.transform("ids", lambda x: F.when(x >= 0, F.array(x)).otherwise(F.col("own")[-x - 1])))
    return done.unionByName(open_.select("row", "key", "ids").join(found, "row").select(F.col("key").alias(key), filled.alias("ids")))


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", alias: str = "text") -> DataFrame:
    """encoded with the text of its ids: the pieces' bytes are concatenated, ``RUN`` at a time, then read as UTF-8."""
    ranks = read_ranks(path or vocabulary())
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    row = encoded.sparkSession.createDataFrame([(0, pieces)], "one int, pieces array<binary>")
    # rows are chunked so that the pieces are not copied beside each of them
    kept = encoded.columns
    chunks = encoded.withColumn("_c", F.pmod(F.xxhash64(ids), F.lit(max(1, -(-encoded.count() // 500))))).groupBy("_c").agg(F.collect_list(F.struct(*kept)).alias("_rows")).withColumn("one", F.least("_c", F.lit(0)).cast("int"))
    nothing = F.lit(b"")
    join = lambda of, use: F.aggregate(of, nothing, lambda whole, x: F.concat(whole, use(x)))

    def text(x: Column) -> Column:
        own = F.coalesce(x[ids], F.array().cast("array<int>"))
        runs = F.filter(F.sequence(F.lit(0), F.size(own) - 1 + RUN, F.lit(RUN)), lambda i: i < F.size(own))
        piece = lambda i: F.coalesce(F.get(F.col("pieces"), i), nothing)
        return F.decode(join(runs, lambda at: join(F.slice(own, at + 1, RUN), piece)), "utf-8")

    return chunks.join(F.broadcast(row), "one").select(F.inline(F.transform("_rows", lambda x: F.struct(*[x[c].alias(c) for c in kept], text(x).alias(alias)))))
