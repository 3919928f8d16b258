"""Best-fit packing by exact-complement hashing.

Packing looks only at how many pieces there are of each length (a histogram of
at most ``capacity`` entries, whatever the corpus). ``plan`` takes lengths from
long to short and, for the gap a piece leaves, looks up single lengths, pair sums
and triple sums that fill the gap exactly, consuming each combination as often
as its lengths' counts allow; what is left is packed best-fit, equal bins as one
counted group. The plan is a short list of patterns with counts.

Spark applies the plan: pieces are ranked within their length in chunks of
bounded size (counts per chunk, prefix sums over the chunks), and a piece's rank
says which pattern, sequence and place it takes. No group of equal lengths is
ever gathered, and no piece is moved by the driver.

With ``span_rows`` the rows' order counts: spans of that many rows, however many
there are, are planned and packed each on its own, in tasks, so a span's sequences
hold its rows only and come before the next span's; within a span pieces of equal
length are placed in the rows' order. Sequence ``k`` of span ``s`` has the number
``s * 2**32 + k``. The order is the one in
which the table was written (part files by number, rows by their place in them).

Defined results:

* null or empty text: the document is its end id alone;
* null or repeated ids: every row is a document of its own;
* only documents above ``capacity`` ids are cut, from their end, so all pieces
  but the first have ``capacity`` ids;
* ties (equal lengths) are interchangeable and are ranked by staged chunk, id
  and piece; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage
from .tokens import MEMO_PIECES, TEXTS_AT_ONCE, crc32_u32, encoder

CAPACITY = 2048
#: pieces of one length that are ranked in one chunk at most
CHUNK = 8192
#: pieces of a span that one task places at once, about
PART = 4096
RUN = ("length", "first", "base", "n", "offset")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk bigint"

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
              text_col: str = "text", keep_ids: bool = False, memo_pieces: int = MEMO_PIECES, ordered: bool = False) -> DataFrame:
    """One row per piece; ``keep_ids`` adds the piece's ids (little-endian
    unsigned 32-bit) as binary column ``ids``, ``ordered`` its row's ``part`` and
    ``row``, by which the table is in order."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "chunk"] + ["ids"] * keep_ids + ["part", "row"] * ordered

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        enc, end = encoder(tokenizer, memo_pieces), np.array([end_id], dtype=np.uint32)
        chunk, made = TaskContext.get().partitionId() << 32, 0
        for pdf in batches:
            for a in range(0, len(pdf), TEXTS_AT_ONCE):
                part, rows = pdf.iloc[a : a + TEXTS_AT_ONCE], []
                doc_ids = part["doc_id"].tolist()
                places = list(zip(part["part"], part["row"], strict=True)) if ordered else [()] * len(part)
                for d, ids, place in zip(doc_ids, enc.encode(part["text"].tolist()), places, strict=True):
                    ids = np.concatenate([ids, end])
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        own = ids[s : s + n]
                        rows.append((d, k, s, n, crc32_u32(own), chunk + made // CHUNK)
                                    + ((own.astype("<u4").tobytes(),) if keep_ids else ()) + place)
                        made += 1
                yield pd.DataFrame(rows, columns=columns)

    # pandas would hold numbers beside nulls as doubles: ids go through it as text
    own = [F.col(id_col).cast("bigint").cast("string").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")]
    rows = docs.select(*own, *(_order(docs) if ordered else ()))
    out = rows.mapInPandas(tokenise, PIECES.replace("doc_id bigint", "doc_id string") + ", ids binary" * keep_ids + ", part string, row bigint" * ordered)
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _order(docs: DataFrame) -> list[Column]:
    """``part`` and ``row``: a row's place in the written table, or in the
    partitions of one that is not read from files."""
    at = F.monotonically_increasing_id()
    number, name, row = F.shiftright(at, 33), F.lit(""), at.bitwiseAND(F.lit((1 << 33) - 1))
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta["row_index"]).schema  # noqa: B018 - analysed here
    except AnalysisException:
        pass
    else:  # splits of files are read in any order
        name, row = meta["file_name"], meta["row_index"]
        number = F.coalesce(F.regexp_extract(name, r"^part-([0-9]+)", 1).try_cast("bigint"), F.lit(0))
    return [F.concat(F.lpad(number.cast("string"), 20, "0"), name).alias("part"), row.cast("bigint").alias("row")]


def in_spans(pieces: DataFrame, span_rows: int) -> DataFrame:
    """Staged pieces with ``span`` and their row's number ``at`` for ``part`` and ``row``."""
    files = sorted(tuple(r) for r in pieces.groupBy("part").agg(F.max("row") + 1).collect())  # one row per file
    bases = [(part, int(n)) for (part, _), n in zip(files, np.cumsum([0, *[n for _, n in files]]), strict=False)]
    bases = pieces.sparkSession.createDataFrame(bases, "part string, base bigint")
    out = pieces.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("row"))
    # chunks in the rows' order: a span's lengths are ranked over few rows each
    return out.withColumns({"span": F.floor(F.col("at") / span_rows), "chunk": F.floor(F.col("at") / 1024)}).drop("part", "row", "base")


def _fill(counts: np.ndarray, capacity: int, small_first: bool, partners: int = 3) -> list[tuple[Pattern, int]]:
    """Combinations of a piece and up to ``partners`` others that fill a sequence
    exactly, consumed from ``counts`` (changed in place)."""
    taken: list[tuple[Pattern, int]] = []

    def consume(lengths: tuple[int, ...]) -> None:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        k = min(int(counts[x]) // m for x, m in need.items())
        if k:
            taken.append((tuple(sorted(need.items(), reverse=True)), k))
            for x, m in need.items():
                counts[x] -= k * m

    def in_order(xs: np.ndarray) -> np.ndarray:
        return xs if small_first else xs[::-1]

    def pairs(total: int, most: int) -> np.ndarray:
        """Longer halves of the available pairs of this sum."""
        a = np.arange((total + 1) // 2, min(most, total - 1) + 1)
        return in_order(a[(counts[a] > 0) & (counts[total - a] > 0)]) if len(a) else a

    for top in range(capacity, 0, -1):
        gap = capacity - top
        if not counts[top]:
            continue
        if gap == 0:
            consume((top,))
            continue
        if gap <= top:
            consume((top, gap))
        for a in pairs(gap, top) if counts[top] and partners > 1 else ():
            consume((top, int(a), int(gap - a)))
            if not counts[top]:
                break
        if not counts[top] or partners < 3:
            continue
        for a in in_order(np.flatnonzero(counts[: min(top, gap - 2) + 1])) if gap > 2 else ():
            for b in pairs(gap - int(a), min(int(a), top)):
                consume((top, int(a), int(b), int(gap - a - b)))
                if not counts[top] or not counts[a]:
                    break
            if not counts[top]:
                break
    return taken


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over what is left; equal bins are one counted group."""
    bins: dict[int, dict[Pattern, int]] = {}  # gap -> pattern -> how many

    def put(gap: int, pattern: Pattern, n: int) -> None:
        own = bins.setdefault(gap, {})
        own[pattern] = own.get(pattern, 0) + n

    for x in range(capacity, 0, -1):
        left = int(counts[x])
        while left:
            gap = min((g for g in bins if g >= x), default=None)
            if gap is None:  # new sequences, each filled with as many as fit
                per = capacity // x
                if left >= per:
                    put(capacity - per * x, ((x, per),), left // per)
                if left % per:
                    put(capacity - left % per * x, ((x, left % per),), 1)
                break
            pattern, n = next(iter(bins[gap].items()))
            fit = min(gap // x, left)
            k = min(n, left // fit)
            if n == k:
                del bins[gap][pattern]
                if not bins[gap]:
                    del bins[gap]
            else:
                bins[gap][pattern] = n - k
            put(gap - fit * x, (*pattern, (x, fit)), k)
            left -= k * fit
    return [(p, n) for own in bins.values() for p, n in own.items()]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences take each; all pieces are placed. Greedy
    use of long combinations can leave worse residuals, so plans with at most
    one, two and three partners, in both orders, are made; the shortest is taken."""
    plans = []
    for partners, small_first in ((1, False), (2, True), (2, False), (3, True), (3, False)):
        left = np.zeros(capacity + 1, dtype=np.int64)
        for x, n in counts.items():
            left[x] = n
        plans.append(_fill(left, capacity, small_first, partners) + _best_fit(left, capacity))
    return min(plans, key=lambda p: sum(n for _, n in p))


def _ranges(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For each length, ascending, runs of ranks: first rank, first sequence,
    sequences, offset of the pattern's first piece of this length."""
    rows, base, used = [], 0, {}
    for pattern, n in patterns:
        offset = 0
        for x, m in pattern:
            rows.append((x, used.get(x, 0), base, n, offset))
            used[x] = used.get(x, 0) + n * m
            offset += x * m
        base += n
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(RUN, cols, strict=True))


def _place(pdf: pd.DataFrame, ranges: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by ``length`` and ``rank``."""
    keys, starts = np.unique(ranges["length"], return_index=True)
    ends = np.append(starts[1:], len(ranges["length"]))
    x, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
    at = np.empty(len(pdf), dtype=np.int64)
    own = np.searchsorted(keys, x)
    for k in np.unique(own):
        rows = own == k
        at[rows] = starts[k] + np.searchsorted(ranges["first"][starts[k] : ends[k]], rank[rows], side="right") - 1
    step = rank - ranges["first"][at]
    return ranges["base"][at] + step % ranges["n"][at], ranges["offset"][at] + step // ranges["n"][at] * x


def _ranked(pieces: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pieces with their ``rank`` among those of equal ``keys``, counted chunk by
    chunk, and the staged counts of the chunks."""
    per_chunk = stage(pieces.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n")), "pack-chunks")
    before = Window.partitionBy(*keys).orderBy("chunk")
    first = per_chunk.select(*keys, "chunk", (F.sum("n").over(before) - F.col("n")).alias("first_rank"))
    order = [c for c in ("at", "doc_id", "piece", "ids_crc32") if c in pieces.columns]
    within = Window.partitionBy(*keys, "chunk").orderBy(*order)
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(first, [*keys, "chunk"])
    return ranked.withColumn("rank", F.col("rank") + F.col("first_rank")).drop("first_rank", "chunk"), per_chunk


def _texted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("doc_id").cast("string"))


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged: it is read more than once; columns of ``PIECES``, and
    ``span`` and ``at`` if the order counts) with ``sequence_id`` and ``offset``;
    the working columns are dropped."""
    kept = [c for c in pieces.columns if c not in ("chunk", "span", "at")]
    types = {f.name: f.dataType.simpleString() for f in pieces.schema} | {"doc_id": "string"}
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", sequence_id bigint, offset bigint"
    if "span" in pieces.columns:
        return _numbered(_pack_spans(pieces, capacity, kept, schema))
    ranked, per_chunk = _ranked(pieces, ["length"])
    histogram = per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    ranges = _ranges(plan({r["length"]: r["n"] for r in histogram}, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence, offset = _place(pdf, ranges)
            yield pdf[kept].assign(sequence_id=sequence, offset=offset)

    return _numbered(_texted(ranked).select(*kept, "rank").mapInPandas(place, schema))


def _pack_spans(pieces: DataFrame, capacity: int, kept: list[str], schema: str) -> DataFrame:
    """Each span by a plan of its own: plans are made in tasks, one span at a time,
    and meet the span's pieces in parts of about ``PART``."""
    ranked, per_chunk = _ranked(pieces, ["span", "length"])
    histogram = per_chunk.groupBy("span", "length").agg(F.sum("n").alias("n"))

    def plan_span(pdf: pd.DataFrame) -> pd.DataFrame:  # at most `capacity` rows
        ranges = _ranges(plan(dict(zip(pdf["length"].tolist(), pdf["n"].tolist(), strict=True)), capacity))
        return pd.DataFrame(ranges)[list(RUN)].assign(span=pdf["span"].iloc[0], parts=-(-int(pdf["n"].sum()) // PART))

    runs = stage(histogram.groupBy("span").applyInPandas(plan_span, ", ".join(f"{c} bigint" for c in RUN) + ", span bigint, parts int"), "pack-plans")
    parts = runs.groupBy("span").agg(F.max("parts").alias("parts"))
    met = runs.withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    dealt = ranked.join(parts, "span").withColumn("part_", F.pmod(F.xxhash64("length", "rank"), F.col("parts")).cast("int")).drop("parts", "at")

    def place(own: pd.DataFrame, planned: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=[*kept, "sequence_id", "offset"])
        planned = planned.sort_values(["length", "first"])
        sequence, offset = _place(own, {c: planned[c].to_numpy(np.int64) for c in RUN})
        return own[kept].assign(sequence_id=(own["span"].to_numpy(np.int64) << 32) + sequence, offset=offset)

    key = ["span", "part_"]
    return _texted(dealt).groupBy(*key).cogroup(met.groupBy(*key)).applyInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False, memo_pieces: int = MEMO_PIECES,
                   span_rows: int | None = None) -> DataFrame:
    """Tokenises, cuts and packs ``docs``; see the module's text. ``memo_pieces``
    bounds a worker's memory, not the results."""
    pieces = pieces_of(docs, tokenizer, end_id, capacity, id_col, text_col, keep_ids, memo_pieces, span_rows is not None)
    pieces = stage(pieces, "pack-pieces")
    return pack(pieces if span_rows is None else in_spans(pieces, span_rows), capacity)
