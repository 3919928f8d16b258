"""SimHash near-dedup with pigeonring filtering.

A document's fingerprint: one bit per hash bit, 1 where over half of its word
shingles' XXH64 hashes have that bit set. Documents link when their fingerprints
differ in at most ``max_bits`` bits; linked documents form components.

Links are searched between distinct fingerprints only. The 64 bits are a ring of
``max_bits + 1`` segments. If two fingerprints differ in at most ``max_bits`` bits,
then by the pigeonring principle some segment starts a chain in which the first
``l`` consecutive segments together differ in at most ``l * max_bits / segments``
bits, for every ``l``. The first segment of the chain must thus be equal and the
second may differ in one bit, so one of its halves is equal too: (start, segment,
half) is the join key, and pairs that meet in a key must pass the chain's
cumulative budgets before the full Hamming check.

A key that more than ``bucket`` fingerprints share is not paired at all: its
fingerprints link exactly, in linear space, through the words within one bit of
them — two fingerprints differ in at most two bits if and only if such a word is
common to both — by a star to the smallest fingerprint around each word.

Defined results: words are maximal runs of bytes other than space and 9-13; null
and empty texts and texts without words have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; rows that share an id have
a fingerprint each; rows with a null id get the component of their fingerprint
and never name one (null if no id is reachable); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import connected_components
from . import tokens
from .common import HOT_ROWS, fresh, may_be_among, quoted, salted, stage

SEED = 42
BUCKET = 64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 14):
        octets = hashes[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with a 64-bit fingerprint column."""

    @F.pandas_udf("bigint")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens.release()
        for s in texts:
            yield pd.Series([fingerprint(t, shingle) for t in s], dtype="int64")

    return docs.withColumn(out, of(text_col))


def _bits(word: Column, low: int, high: int) -> Column:
    """Bits ``low`` to ``high - 1`` of a word."""
    return F.shiftrightunsigned(word, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def _ring(max_bits: int) -> list[tuple[int, int]]:
    m = max_bits + 1
    edges = [round(64 * k / m) for k in range(m + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def links(fingerprints: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` between the distinct values of column ``fp``, staged: they
    connect exactly the fingerprints that a chain of steps of at most
    ``max_bits`` bits connects. All direct links are among them but those within
    keys of over ``bucket`` fingerprints, which are stars."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits: 1 or 2")
    ring = _ring(max_bits)
    m, fp = len(ring), F.col("fp")
    keys = []
    for i, (a, b) in enumerate(ring):
        c, d = ring[(i + 1) % m]
        mid = (c + d) // 2
        for half, (e, f) in enumerate(((c, mid), (mid, d))):
            keys.append(F.struct(F.lit(2 * i + half).alias("k"), _bits(fp, a, b).alias("seg"), _bits(fp, e, f).alias("part")))
    keyed = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")
    key = ["k", "seg", "part"]
    shared = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    meeting = stage(keyed.join(shared, key), "simhash-keys")

    few = meeting.where(F.col("n") <= bucket)
    pairs = few.select(*key, F.col("fp").alias("a")).join(few.select(*key, F.col("fp").alias("b")), key)
    xor = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(False)
    for i in range(m):  # cumulative differences of the chain that starts at the key's segment
        total, ok = F.lit(0), F.col("k").isin(2 * i, 2 * i + 1)
        for step in range(m):
            total = total + F.bit_count(_bits(xor, *ring[(i + step) % m]))
            ok = ok & (total * m <= (step + 1) * max_bits)
        chain = chain | ok
    near = pairs.where((F.col("a") < F.col("b")) & chain & (F.bit_count(xor) <= max_bits)).select("a", "b")

    many = meeting.where(F.col("n") > bucket).select("fp").distinct()
    flips = [F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)]
    if max_bits == 2:
        around = many.select("fp", F.explode(F.array(fp, *flips)).alias("word"), F.lit(0).alias("pos"))
    else:  # words less one bit: equal for fingerprints that differ there at most
        less = F.array(*[F.struct(fp.bitwiseAND(F.lit(~(1 << k) if k < 63 else (1 << 63) - 1)).alias("word"), F.lit(k).alias("pos")) for k in range(64)])
        around = many.select("fp", F.explode(less).alias("w")).select("fp", "w.*")
    centre = around.groupBy("word", "pos").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top")
    stars = around.join(centre.drop("top"), ["word", "pos"]).where("a < fp").select("a", F.col("fp").alias("b"))
    return stage(near.unionByName(stars).distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text",
                    bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint`` (16 lower-case hex digits) and ``component_id`` (the
    smallest reachable id) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(with_fingerprint(rows, shingle, out="fp").select("doc_id", "fp"), "simhash-rows")
    return components(rows, max_bits, bucket).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def components(rows: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """``rows`` (staged ``doc_id, fp`` and more) with ``component_id`` and ``label``, which
    tells components without any id apart too."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    comps = connected_components(links(distinct.select("fp"), max_bits, bucket))
    labelled = distinct.join(comps.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp"))
    labelled = stage(labelled, "simhash-labels")
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_fp = stage(labelled.join(least, "label").select("fp", "component_id", "label"), "simhash-by-fp")
    # a group of exact copies meets its fingerprint's row in many places
    hot = distinct.where(F.col("n") > HOT_ROWS)
    many, few = may_be_among(rows, F.col("fp"), hot, F.col("fp"))
    met = may_be_among(by_fp, F.col("fp"), hot, F.col("fp"))[0]
    return few.join(by_fp, "fp").unionByName(salted(many, met, "fp", F.col("doc_id")))


def keep_first(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text",
               bucket: int = BUCKET) -> DataFrame:
    """One of ``docs``' rows of each component: of those of its smallest id, or of
    all if it has no id, those of the smallest fingerprint, of these those of the
    smallest text hash, and of these the row of the smallest hash of all columns.
    All columns are returned.

    Rows are told by id and text hash. Only documents that may share these with a
    row that goes, or with one that repeats, are dealt out; all others stay where
    they are."""
    own_id, own_hash, went, copies = fresh(docs, "__id", "__hash", "__went", "__copies")
    text = quoted(text_col)
    key = F.struct(quoted(id_col).cast("bigint"), F.xxhash64(text))
    told = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = stage(with_fingerprint(told, shingle, out="fp").select("doc_id", "text_hash", "fp"), "simhash-rows")
    found = components(rows, max_bits, bucket).groupBy("label", "doc_id", "fp", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    found = stage(found, "simhash-found")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash"))
    heads = found.groupBy("label").agg(best.alias("best"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash") == F.col("best")
    touched = found.join(heads, "label").select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash),
                                                (~first).alias(went), F.col("copies").alias(copies))
    touched = stage(touched.where(F.col(went) | (F.col(copies) > 1)), "simhash-touched")
    some, same = may_be_among(docs, key, touched, F.struct(own_id, own_hash))
    names = [quoted(c) for c in docs.columns]
    left = some.withColumns({f"{own_id}_l": quoted(id_col).cast("bigint"), f"{own_hash}_l": F.xxhash64(text)})
    out = left.join(touched, F.col(f"{own_id}_l").eqNullSafe(F.col(own_id)) & (F.col(f"{own_hash}_l") == F.col(own_hash)), "left")
    free = out.where(F.col(went).isNull()).select(*names)
    # copies collapse before they are dealt out: a grouped minimum, no window
    text_of_all = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in docs.schema[n].dataType.simpleString() else c for n, c in zip(docs.columns, names)])
    one = (out.where(~F.col(went)).groupBy(own_id, own_hash)
           .agg(F.min_by(F.struct(*names), text_of_all).alias("row")).select("row.*"))
    return same.unionByName(free).unionByName(one)
