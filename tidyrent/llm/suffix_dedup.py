"""Repeated passages across documents, by a sparse suffix array over words.

Only the suffixes that start at content-selected *minimisers* are kept: of every
``window`` consecutive ``gram``-word grams the one with the smallest hash. Two
documents that share a passage of ``min_words`` words select the same first
minimiser in it, at most ``window - 1`` words after its start, so they also share
the ``context = min_words - window + 1`` words from there on.

The suffixes are sorted over the whole cluster by those words' hash, document and
place (range partitions, so one passage in very many documents spreads over
tasks); neighbours with equal words form runs. Of a run of two the later suffix is
compared with the first. In longer runs the first suffix need not share
``min_words`` words with the others, so there every window of ``min_words`` words is
looked up: it belongs to the one minimiser that it selects itself, its hash is
sorted in the same way, and it is compared with the first document that has it.
So each window that an earlier document has is found, in time linear in the words.
Both texts are brought together and, aligned at that place, the match is verified
word by word and extended to the left and right as far as it goes, and on beyond
single edits. What is at least ``min_words`` long is a repeat: the earlier document
keeps the passage, the later one's copy is the returned span.
Runs that cross a range boundary get their first suffix and whether they are
longer than two from grouped aggregates.

Words are separated by white space (``str.split``); spans are cut at words.

Defined results: null, empty and short texts have no spans; texts of any length
are read whole; repeats within one document are not reported; rows with a null
id are not compared; rows that share an id are one document and are not compared
with each other, spans name the text they were found in by its hash; exact
repeats of a row count once; ties keep the smaller id; an empty table gives no
rows; other columns are passed through unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import HOT_ROWS, free, fresh, may_be_among, quoted, salted, small_side, stage

MIN_WORDS = 50
GRAM = 5
WINDOW = 26
#: bits of the map of hashes that more than two suffixes share; false hits cost windows, never results
MAP_BITS = 25

SUFFIX = "key bigint, doc bigint, pos int"
MEMBER = "key bigint, doc bigint, pos int, head_doc bigint, head_pos int, crowded boolean, edge boolean"
SPAN = ("doc_id bigint, text_hash bigint, start_word int, end_word int, start_char int, end_char int,"
        "match_doc_id bigint, match_start_word int")

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_WORD = re.compile(r"\S+")


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, b, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> list[int]:
    digest = xxhash.xxh64_intdigest
    return [digest(w) for w in text.split()]


def _grams(hashes: list[list[int]], gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the documents' words in one row: each word's document, the documents'
    first words, prefix sums and inverse powers for hashes, and the grams' hashes."""
    sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
    n = int(sizes.sum())
    flat = np.fromiter((x for h in hashes for x in h), dtype=np.uint64, count=n)
    doc = np.repeat(np.arange(len(hashes)), sizes)
    up, down = _power(n + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(flat * up[:n])])
    grams = _mix((total[gram:] - total[: n - gram + 1]) * down[: n - gram + 1])
    return doc, np.cumsum(sizes) - sizes, total, down, grams


def minimiser_suffixes(hashes: list[list[int]], gram: int, window: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, word position, hash of the next ``context`` words)`` of the
    retained suffixes of some documents, given as their words' hashes."""
    n = sum(map(len, hashes))
    none = np.zeros(0, dtype=np.int64)
    if n < window + gram - 1:
        return none, none, none.astype(np.uint64)
    doc, first, total, down, grams = _grams(hashes, gram)
    span = window + gram - 1
    inside = doc[: n - span + 1] == doc[span - 1 :]
    view = np.lib.stride_tricks.sliding_window_view(grams, window)[: n - span + 1]
    chosen = np.zeros(n, dtype=bool)
    for lo in range(0, len(view), 1 << 16):
        own = np.flatnonzero(inside[lo : lo + (1 << 16)]) + lo
        chosen[own + np.argmin(view[own], axis=1)] = True
    at = np.flatnonzero(chosen)
    at = at[at + context <= n]
    at = at[doc[at] == doc[at + context - 1]]
    key = _mix((total[at + context] - total[at]) * down[at])
    return doc[at], at - first[doc[at]], key


def minimiser_windows(hashes: list[list[int]], wanted: list[np.ndarray], gram: int, window: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, word position, hash)`` of the windows of ``words`` words whose
    first ``window`` grams select a minimiser at one of the document's ``wanted``
    positions. Equal windows select alike."""
    n = sum(map(len, hashes))
    none = np.zeros(0, dtype=np.int64)
    if n < words:
        return none, none, none.astype(np.uint64)
    doc, first, total, down, grams = _grams(hashes, gram)
    asked = np.zeros(n, dtype=bool)
    for k, places in enumerate(wanted):
        asked[first[k] + places[places < len(hashes[k])]] = True
    near = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(asked)])
    starts = np.arange(n - words + 1)
    starts = starts[(doc[starts] == doc[starts + words - 1]) & (near[starts + window] > near[starts])]
    view = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = [part[asked[part + np.argmin(view[part], axis=1)]] for lo in range(0, len(starts), 1 << 16) for part in [starts[lo : lo + (1 << 16)]]]
    at = np.concatenate([none, *at])
    key = _mix((total[at + words] - total[at]) * down[at])
    return doc[at], at - first[doc[at]], key


def suffixes(docs: DataFrame, id_col: str, text_col: str, gram: int, window: int, context: int) -> DataFrame:
    def retain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens.release()
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                part = pdf.iloc[a : a + 256]
                doc, pos, key = minimiser_suffixes([word_hashes(t) for t in part["text"]], gram, window, context)
                yield pd.DataFrame({"key": key.view(np.int64), "doc": part["doc"].to_numpy()[doc], "pos": pos.astype(np.int32)})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).where(
        "doc is not null and text is not null")
    return rows.mapInPandas(retain, SUFFIX)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits at the low ``MAP_BITS`` bits of ``key``: a map of fixed size, put together
    by a grouped aggregate from 64-bit words."""
    at = F.col("key").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    words = keys.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
    rows = words.toPandas()  # at most 2 ** (MAP_BITS - 6) rows
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def windows(docs: DataFrame, crowded: DataFrame, id_col: str, text_col: str, gram: int, window: int, words: int) -> DataFrame:
    """Windows of the suffixes in ``crowded`` (``key, doc``), in ``SUFFIX``'s columns.
    They are made where the texts lie: documents that have none are told by their
    id's hash, and a document's other suffixes by the map of keys."""
    known = _bitmap(crowded.select("key").distinct())
    context = words - window + 1

    def retain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens.release()
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                part = pdf.iloc[a : a + 256]
                hashes = [word_hashes(t) for t in part["text"]]
                doc, pos, key = minimiser_suffixes(hashes, gram, window, context)
                at = key & np.uint64((1 << MAP_BITS) - 1)
                hit = (known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                doc, pos = doc[hit], pos[hit]
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                wanted = [pos[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                doc, pos, key = minimiser_windows(hashes, wanted, gram, window, words)
                yield pd.DataFrame({"key": key.view(np.int64), "doc": part["doc"].to_numpy()[doc], "pos": pos.astype(np.int32)})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).where(
        "doc is not null and text is not null")
    return may_be_among(rows, F.col("doc"), crowded, F.col("doc"))[0].mapInPandas(retain, SUFFIX)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of sorted suffixes, those with an equal neighbour, with their run's first
    suffix. ``crowded``: the run has more than two. ``edge``: the suffix has the
    partition's first key or is among its last, so its run may go on in another
    partition."""
    held = None  # last rows so far, all of the last run if it has two at most
    before = (0, 0, 0)  # rows of that run before them, its first suffix
    first_key = None

    def found(key, doc, pos, more):
        n = len(key)
        turn = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        length = np.diff(np.append(turn, n))
        head_doc, head_pos, size = doc[turn], pos[turn], length.copy()
        if before[0]:
            head_doc[0], head_pos[0] = before[1:]
            size[0] += before[0]
        keep = 0 if not more else length[-1] if size[-1] <= 2 else 1
        state = (int(size[-1] - keep), int(head_doc[-1]), int(head_pos[-1]))
        head_doc, head_pos, size = (np.repeat(x, length) for x in (head_doc, head_pos, size))
        edge = key == first_key
        if not more:
            edge = np.ones(n, dtype=bool)
        take = np.flatnonzero(((size > 1) | edge)[: n - keep])
        out = pd.DataFrame({"key": key[take], "doc": doc[take], "pos": pos[take], "head_doc": head_doc[take],
                            "head_pos": head_pos[take], "crowded": size[take] > 2, "edge": edge[take]})
        return out, tuple(x[n - keep :] for x in (key, doc, pos)), state

    for pdf in batches:
        if not len(pdf):
            continue
        rows = tuple(pdf[c].to_numpy() for c in ("key", "doc", "pos"))
        if first_key is None:
            first_key = int(rows[0][0])
        if held is not None:
            rows = tuple(np.concatenate([h, x]) for h, x in zip(held, rows, strict=True))
        out, held, before = found(*rows, more=True)
        yield out
    if held is not None:
        yield found(*held, more=False)[0]


def _members(kept: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``key, doc, pos``, their run's ``head_doc, head_pos`` and ``crowded`` of
    staged suffixes, which go."""
    order = ["key", "doc", "pos"]
    members = stage(kept.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_runs, MEMBER), f"{name}-runs")
    free(kept)
    # only a partition's first and last keys can go on elsewhere; their rows know
    # the first suffix of the run, and its size, as far as their own partition has it
    heads = members.where("edge").groupBy("key").agg(
        F.min(F.struct(F.col("head_doc").alias("doc"), F.col("head_pos").alias("pos"))).alias("head"),
        (F.max("crowded") | (F.count(F.lit(1)) > 2)).alias("many"))
    heads = small_side(heads, f"{name}-edge-heads")
    return members, members.join(heads, "key", "left").select(
        "key", "doc", "pos", F.coalesce("head.doc", "head_doc").alias("head_doc"), F.coalesce("head.pos", "head_pos").alias("head_pos"),
        (F.col("crowded") | F.coalesce("many", F.lit(False))).alias("crowded"))


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW,
            min_words: int = MIN_WORDS) -> DataFrame:
    """Staged ``doc, other, shift``: ``doc`` may share a window with ``other``, an
    earlier document, whose words lie ``shift`` places before; every window of
    ``doc`` that some earlier document has is in one such pair. Linear in the words."""
    kept = stage(suffixes(docs, id_col, text_col, gram, window, min_words - window + 1), "suffixes")
    written, members = _members(kept, "suffix")
    crowded = stage(members.where("crowded").select("key", "doc").distinct(), "suffix-crowded")
    written_too, whole = _members(stage(windows(docs, crowded, id_col, text_col, gram, window, min_words), "windows"), "window")
    both = members.where("not crowded").unionByName(whole).where("head_doc < doc")
    out = stage(both.select("doc", F.col("head_doc").alias("other"), (F.col("pos") - F.col("head_pos")).alias("shift")).distinct(), "suffix-matches")
    for table in (written, written_too, crowded):
        free(table)
    return out


def _along(a: np.ndarray, b: np.ndarray, shift: int, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` equal words of ``a`` and ``b`` laid so
    that word ``i`` of ``a`` meets word ``i - shift`` of ``b``."""
    lo, hi = max(0, shift), min(len(a), len(b) + shift)
    if hi - lo < least:
        return []
    equal = np.zeros(hi - lo + 2, dtype=np.int8)
    equal[1:-1] = a[lo:hi] == b[lo - shift : hi - shift]
    turn = np.flatnonzero(np.diff(equal))
    starts, ends = turn[::2], turn[1::2]
    long = ends - starts >= least
    return list(zip((starts[long] + lo).tolist(), (ends[long] + lo).tolist(), strict=True))


def _spans(text: str, other: str, shifts: list[int], min_words: int) -> list[tuple[int, int, int, int, int]]:
    """Verified repeats of ``other`` in ``text``: words, characters, other's word."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)] if not text.isascii() or any(c in text for c in "\x1c\x1d\x1e\x1f") else None
    own, its = text.split(), other.split()
    number: dict[str, int] = {}
    a = np.fromiter((number.setdefault(w, len(number)) for w in own), dtype=np.int64, count=len(own))
    b = np.fromiter((number.setdefault(w, len(number)) for w in its), dtype=np.int64, count=len(its))
    out = [(x, y, x - d) for d in sorted(shifts) for x, y in _along(a, b, d, min_words)]
    if not out:
        return []
    if words is None or len(words) != len(own):
        words, at = [], 0
        for w in own:
            at = text.index(w, at)
            words.append((at, at + len(w)))
            at += len(w)
    return [(s, e, words[s][0], words[e - 1][1], q) for s, e, q in out]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per repeat of at least ``min_words`` words (columns of ``SPAN``)."""
    context = min_words - window + 1
    if context < gram or window < 2:
        raise ValueError("min_words must leave at least `gram` words after a window")
    found = matches(docs, id_col, text_col, gram, window, min_words)
    pairs = found.groupBy("doc", "other").agg(F.collect_list("shift").alias("shifts"))
    pairs = stage(pairs, "suffix-pairs")
    free(found)
    ids = pairs.select("doc").unionByName(pairs.select(F.col("other").alias("doc")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    # only texts that may be in a pair are dealt out, once, and read by both joins
    texts = (may_be_among(rows, F.col("doc"), ids, F.col("doc"))[0].withColumn("text_hash", F.xxhash64("text"))
             .repartition("doc").dropDuplicates(["doc", "text_hash"]))
    others = texts.select(F.col("doc").alias("other"), F.col("text").alias("other_text"))

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                for s, e, c, d, q in _spans(r.text, r.other_text, [int(x) for x in r.shifts], min_words):
                    rows.append((r.doc, r.text_hash, s, e, c, d, r.other, q))
            yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "start_word", "end_word", "start_char", "end_char", "match_doc_id", "match_start_word"])

    # the first document of a common passage is met by all that repeat it
    hot = pairs.groupBy("other").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS)
    many, few = may_be_among(pairs, F.col("other"), hot, F.col("other"))
    met = may_be_among(others, F.col("other"), hot, F.col("other"))[0]
    both = few.join(texts, "doc").join(others, "other").unionByName(salted(many.join(texts, "doc"), met, "other", F.col("doc")))
    return both.select("doc", "text", "text_hash", "other", "other_text", "shifts").mapInPandas(extend, SPAN)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from the later documents; a document
    of which nothing but white space is left goes. Others are unchanged."""
    spans = repeated_spans(docs, id_col, text_col, min_words, gram, window)
    own_id, own_hash, own_cuts = fresh(docs, "__id", "__hash", "__cuts")
    cuts = stage(spans.groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash))
                 .agg(F.array_sort(F.collect_set(F.struct("start_char", "end_char"))).alias(own_cuts)), "suffix-cuts")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, cuts, strict=True):
            kept, at = [], 0
            for x in spans:
                if x["start_char"] > at:
                    kept.append(text[at : x["start_char"]])
                at = max(at, x["end_char"])
            out.append("".join([*kept, text[at:]]))
        return pd.Series(out)

    columns = [quoted(c) for c in docs.columns]
    some, same = may_be_among(docs, F.struct(quoted(id_col).cast("bigint"), F.xxhash64(quoted(text_col))), cuts, F.struct(own_id, own_hash))
    keyed = some.withColumns({own_id: quoted(id_col).cast("bigint"), own_hash: F.xxhash64(quoted(text_col))})
    joined = keyed.join(cuts, [own_id, own_hash], "left")
    untouched = joined.where(F.col(own_cuts).isNull()).select(*columns)
    less = joined.where(F.col(own_cuts).isNotNull()).withColumn(text_col, cut(quoted(text_col), own_cuts))
    less = less.where(quoted(text_col).rlike(r"\S")).select(*columns)
    return same.unionByName(untouched).unionByName(less)
