"""Language ID by Bayesian evidence fusion.

For each document the posterior of every language combines

* the text: byte trigrams under a naive Bayes model per language, as the mean
  log-likelihood times at most ``EVIDENCE`` trigrams (neighbouring trigrams are
  not independent; unbounded, a page of text would silence all other evidence);
* the declared markup language and the code in the address (country suffix or
  leading path segment): their likelihood given the language, from grouped counts
  over all rows, for every code that occurs, smoothed towards the code's share of
  all rows;
* the host: counts of the languages that its texts suggest, smoothed towards its
  domain's, that towards its suffix's, that towards all rows' — each a grouped
  aggregation over all rows.

The text model is fitted on all labelled texts, whole, each different one counted
once: a text that a label has n times counts 1/n each time. Labels are codes of two
or three letters, so there are fewer than 18,300 whatever the rows; a label's model
takes 64 KB of a worker. All other statistics cover all rows, too. Texts are read for
the model, for its limits, for the counts and for the decision; none is stored, and
none shuffled unless the repeated ones are too many to broadcast their hashes.

A posterior only compares the known languages. Whether a text is in any of them is
an absolute test: the mean log-likelihood of its trigrams of letters under the
mixture of all languages, against what the labelled texts of its best language
have. Theirs is measured on all labelled texts in two halves, each under the other
half's model; a text may lie ``LIMIT`` deviations below their median, the deviation
being theirs plus that of a mean of so few trigrams. Their quantiles are exact to
``1 / GRID`` nats, so that what is kept for them is bounded. Texts in several known
languages pass, and very short ones, about which their letters say little. Texts
that fail do not count as their host's language.

A row is rejected if its text is null or holds no letter, if its letters fit no
known language, or if its best language's posterior is below ``min_posterior``.

Defined results: null or blank text is judged by the other evidence and
rejected; null or unknown declarations, addresses and hosts are no evidence; very
long texts are read whole; repeated rows are judged alike; without any labelled
row every row is rejected with a null language; an empty table gives no rows;
columns with clashing names pass through (working columns start with ``__lid``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tokens
from .common import small_side, stage

BUCKETS = 1 << 14
#: steps a nat of the measured likelihoods
GRID = 8192.0
#: labels whose counts a worker holds at once
HELD = 128
EVIDENCE = 200.0
SMOOTHING = 8.0
MIN_POSTERIOR = 0.6
LIMIT = 8.0
#: least deviation of a language's texts, in nats a trigram
LEAST_DEVIATION = 0.1

_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(f" {text} ".lower().encode(), dtype=np.uint8)


def _codes(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text."""
    b = _bytes(text).astype(np.uint32)
    tri = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return (tri * np.uint32(2654435761)) >> np.uint32(18)


def _of_letters(text: str) -> np.ndarray:
    """Which trigrams consist of letters: ASCII's and whatever is beyond ASCII."""
    ok = _LETTER[_bytes(text)]
    return ok[:-2] & ok[1:-1] & ok[2:]


def language_code(value: Column) -> Column:
    """Leading two or three letters of a language tag, lower-cased; else null."""
    code = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]{2,3})($|[-_])", 1)
    return F.when(code != "", code)


def fit(labelled: DataFrame, text_col: str, label: Column, per_language: int | None = None) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probabilities of their trigram buckets."""
    return fit_with_limits(labelled, text_col, label, per_language)[:2]


def _counted(totals: dict[tuple[str, int], np.ndarray]) -> Iterator[pd.DataFrame]:
    for (lang, half), own in totals.items():
        some = np.flatnonzero(own)
        yield pd.DataFrame({"lang": lang, "half": half, "bucket": some, "n": own[some]})


def _logs(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts + 0.5).sum(axis=-1, keepdims=True))


def _mixture(model: np.ndarray) -> np.ndarray:
    return np.log(np.exp(model).mean(axis=0)).astype(np.float32)


def fit_with_limits(labelled: DataFrame, text_col: str, label: Column, per_language: int | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """As ``fit``, and per language the median, the deviation and the deviation of
    one trigram of its texts' log-likelihoods a trigram of letters. All texts count,
    unless a caller wants at most ``per_language`` of each label, those of lowest
    hash."""
    rows = labelled.select(F.col(text_col).alias("text"), label.alias("lang")).where("lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    if per_language is not None:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
        rows = rows.join(rows.select("lang", "h").distinct().withColumn("k", rank).where(F.col("k") <= per_language).drop("k"), ["lang", "h"])
    often = rows.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    halves = rows.join(small_side(often, "lid-repeated"), ["lang", "h"], "left").select(
        "text", "lang", F.pmod("h", F.lit(2)).cast("int").alias("half"), (F.lit(1.0) / F.coalesce("times", F.lit(1))).alias("weight"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens.release()
        totals: dict[tuple[str, int], np.ndarray] = {}
        for pdf in batches:
            for text, lang, half, weight in zip(pdf["text"], pdf["lang"], pdf["half"], pdf["weight"], strict=True):
                if (lang, half) not in totals and len(totals) >= HELD:
                    yield from _counted(totals)
                    totals.clear()
                own = totals.setdefault((lang, half), np.zeros(BUCKETS))
                own += np.bincount(_codes(text), minlength=BUCKETS) * weight
        yield from _counted(totals)

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        halves = np.zeros((2, BUCKETS))
        np.add.at(halves, (pdf["half"], pdf["bucket"]), pdf["n"])
        return pd.DataFrame([{"lang": pdf["lang"].iloc[0], "model": _logs(halves.sum(axis=0)).astype("<f4").tobytes(),
                              "halves": np.exp(_logs(halves)).astype("<f4").tobytes()}])

    counted = halves.mapInPandas(count, "lang string, half int, bucket int, n double")
    # every text counts once, so the sums are whole numbers but for rounding
    counted = counted.groupBy("lang", "half", "bucket").agg(F.round(F.sum("n")).cast("bigint").alias("n"))
    models = stage(counted.groupBy("lang").applyInPandas(weigh, "lang string, model binary, halves binary"), "lid-models")
    found, sums = {}, np.zeros((2, BUCKETS))
    for r in models.toLocalIterator():  # one row per label
        found[r["lang"]] = np.frombuffer(r["model"], dtype="<f4")
        sums += np.frombuffer(r["halves"], dtype="<f4").reshape(2, BUCKETS)
    if not found:
        return [], np.zeros((0, BUCKETS), dtype=np.float32), np.zeros((0, 3))
    langs = sorted(found)
    place = {x: k for k, x in enumerate(langs)}
    others = np.log(sums[::-1] / len(langs)).astype(np.float32)  # of each half: the other's mixture

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens.release()
        for pdf in batches:
            out = []
            for text, lang, h in zip(pdf["text"], pdf["lang"], pdf["h"], strict=True):
                own = others[h % 2][_codes(text)[_of_letters(text)]]
                if len(own):
                    out.append((lang, h, round(float(own.mean(dtype=np.float64)) * GRID) / GRID, round(float(own.std(dtype=np.float64)) * GRID) / GRID))
            yield pd.DataFrame(out, columns=["lang", "h", "mean", "sd"])

    measured = rows.mapInPandas(measure, "lang string, h bigint, mean double, sd double").groupBy("lang", "h").agg(
        F.min("mean").alias("mean"), F.min("sd").alias("sd"))
    measured = (measured.groupBy("lang")
             .agg(F.percentile("mean", F.array(F.lit(0.05), F.lit(0.5))).alias("q"), F.percentile("sd", F.lit(0.5)).alias("sd")).collect())
    limits = np.array([[-np.inf, LEAST_DEVIATION, 0.0]] * len(langs))  # no letters to measure: no limit
    for r in measured:
        low, middle = r["q"]
        limits[place[r["lang"]]] = middle, max((middle - low) / 1.645, LEAST_DEVIATION), r["sd"]
    return langs, np.array([found[x] for x in langs]), limits


def _score(model: np.ndarray, evidence: float = EVIDENCE):
    """Pandas UDF: tempered log-likelihoods of a text, one per language, null for
    a text without a letter; number of its trigrams of letters and their mean
    log-likelihood under the mixture of all languages."""
    weights = np.ascontiguousarray(model.T.astype(np.float32))
    mixture = _mixture(model)
    step = max(256, min(1 << 16, (1 << 22) // weights.shape[1]))

    @F.pandas_udf("scores array<double>, letters bigint, mean double")
    def score(texts: pd.Series) -> pd.DataFrame:
        tokens.release()
        out = []
        for t in texts:
            if t is None or not any(map(str.isalpha, t)):
                out.append((None, 0, 0.0))
                continue
            codes, total = _codes(t), np.zeros(weights.shape[1])
            for a in range(0, len(codes), step):
                total += weights[codes[a : a + step]].sum(axis=0, dtype=np.float64)
            letters = codes[_of_letters(t)]
            mean = float(mixture[letters].mean(dtype=np.float64)) if len(letters) else 0.0
            out.append(((total / len(codes) * min(evidence, len(codes))).tolist(), len(letters), mean))
        return pd.DataFrame(out, columns=["scores", "letters", "mean"])

    return score


def _fits(found: Column, best: Column, limits: np.ndarray) -> Column:
    """Whether a text's letters fit its best language (its place, from 0)."""
    middle, deviation, single = (F.get(F.lit([float(x) for x in c]), best) for c in limits.T)
    least = middle - LIMIT * F.sqrt(deviation * deviation + single * single / F.greatest(found["letters"], F.lit(1)))
    return (found["letters"] == 0) | (found["mean"] >= least)


def _counts(votes: DataFrame, key: str, langs: list[str]) -> DataFrame:
    """``key``, ``n``: votes for each language, in their order, and ``whole``, their sum."""
    sums = votes.groupBy(key, "guess").agg(F.sum("n").alias("n"))
    found = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("guess", "n"))).alias("votes"), F.sum("n").alias("whole"))
    return found.select(key, F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), lambda k: F.coalesce(F.try_element_at("votes", k), F.lit(0))).alias("n"), "whole")


def _smoothed(prior: Column, strength: float) -> Column:
    return F.zip_with("n", prior, lambda n, p: (n + F.lit(strength) * p) / (F.col("whole") + F.lit(strength)))


def _totals(votes: DataFrame, langs: list[str]) -> list[int]:
    got = {r["guess"]: r["n"] for r in votes.groupBy("guess").agg(F.sum("n").alias("n")).collect()}  # one row per language
    return [got.get(k, 0) for k in range(len(langs))]


def host_priors(votes: DataFrame, langs: list[str], strength: float = SMOOTHING) -> DataFrame:
    """``host`` and ``__lid_host``: log-priors of the languages. ``votes``: staged
    ``host, guess, n``."""
    hosts = votes.where("host is not null").groupBy("host", "guess").agg(F.sum("n").alias("n")).withColumns(
        {"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)})
    sums = _totals(hosts, langs)
    base = F.lit([(x + 1) / (sum(sums) + len(sums)) for x in sums])
    suffix = _counts(hosts, "suffix", langs).select("suffix", _smoothed(base, strength).alias("above"))
    domain = _counts(hosts, "domain", langs).withColumn("suffix", F.substring_index("domain", ".", -1)).join(suffix, "suffix")
    domain = domain.select("domain", _smoothed(F.col("above"), strength).alias("above"))
    host = _counts(hosts, "host", langs).withColumn("domain", F.substring_index("host", ".", -2)).join(domain, "domain")
    return host.select("host", F.transform(_smoothed(F.col("above"), strength), lambda p: F.log(p)).alias("__lid_host"))


def likelihoods(votes: DataFrame, column: str, langs: list[str], strength: float = SMOOTHING) -> DataFrame:
    """``column`` and ``evidence``: log P(code | language) for every code among the
    staged votes, each smoothed towards the code's share of all."""
    said = votes.where(F.col(column).isNotNull())
    sums = _totals(said, langs)
    share = F.col("whole") / F.lit(float(max(sum(sums), 1)))
    given = F.zip_with("n", F.lit([float(x) for x in sums]), lambda n, total: F.log((n + F.lit(strength) * share) / (total + F.lit(strength))))
    return _counts(said, column, langs).select(column, given.alias("evidence"))


def identify(docs: DataFrame, text_col: str, declared: Column, address: Column, host: Column,
             min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``docs`` with ``__lid_lang``, ``__lid_posterior`` and ``__lid_kept``.
    ``declared`` and ``address``: language tags; ``host``: dotted host or source
    name."""
    langs, model, limits = fit_with_limits(docs, text_col, language_code(declared))
    given = docs.withColumns({"__lid_declared": language_code(declared), "__lid_address": language_code(address), "__lid_host_name": host.cast("string")})
    if not langs:
        return given.drop("__lid_declared", "__lid_address", "__lid_host_name").withColumns(
            {"__lid_lang": F.lit(None).cast("string"), "__lid_posterior": F.lit(None).cast("double"), "__lid_kept": F.lit(False)})
    score = _score(model)
    scored = given.withColumn("__lid_found", score(text_col)).withColumn("__lid_text", F.col("__lid_found.scores"))
    best = F.array_position("__lid_text", F.array_max("__lid_text")).cast("int") - 1
    votes = (scored.where(F.col("__lid_text").isNotNull() & _fits(F.col("__lid_found"), best, limits))
             .groupBy(F.col("__lid_host_name").alias("host"), F.col("__lid_declared").alias("declared"),
                      F.col("__lid_address").alias("address"), best.alias("guess")).agg(F.count(F.lit(1)).alias("n")))
    votes = stage(votes, "lid-votes")
    priors = small_side(host_priors(votes, langs).withColumnRenamed("host", "__lid_host_name"), "lid-hosts")
    zeros = F.array_repeat(F.lit(0.0), len(langs))
    out = scored.join(priors, "__lid_host_name", "left")
    total = F.coalesce("__lid_text", zeros)
    total = F.zip_with(total, F.coalesce("__lid_host", zeros), lambda x, y: x + y)
    for name in ("declared", "address"):
        of_codes = likelihoods(votes, name, langs).withColumnsRenamed({name: f"__lid_{name}", "evidence": f"__lid_by_{name}"})
        out = out.join(small_side(of_codes, f"lid-{name}"), f"__lid_{name}", "left")
        total = F.zip_with(total, F.coalesce(f"__lid_by_{name}", zeros), lambda x, y: x + y)
    out = out.withColumn("__lid_total", total)
    peak = F.array_max("__lid_total")
    mass = F.aggregate("__lid_total", F.lit(0.0), lambda a, x: a + F.exp(x - peak))
    posterior = F.lit(1.0) / mass
    names = F.lit(langs)
    first = F.array_position("__lid_total", peak).cast("int")
    out = out.withColumns({
        "__lid_lang": F.element_at(names, first), "__lid_posterior": posterior,
        "__lid_kept": F.col("__lid_text").isNotNull() & (posterior >= min_posterior) & _fits(F.col("__lid_found"), first - 1, limits)})
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns], "__lid_lang", "__lid_posterior", "__lid_kept")
