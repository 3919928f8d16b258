"""Mixing, chat, URLs and language ID on small cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyrent.llm import chat, langid, mixing, urls


def test_mix_keeps_all_rows_and_the_lag_bound(spark, make_docs):
    sizes = {"a": 120, "b": 60, "c": 7, "": 11}
    rows = [(k, f"t{k}", "en", s or None) for s, n in sizes.items() for k in range(n)] + [(3, "t3", "en", "a"), (None, None, None, "a")]
    docs = make_docs(rows)
    weights = {"a": 5, "b": 3, "none here": 9}
    out = mixing.interleave(docs, weights, default_weight=2, block_rows=4).collect()
    assert len(out) == len(rows)
    places = sorted((r["__mix_slot"], r["__mix_place"]) for r in out)
    assert len(set(places)) == len(rows)
    blocks = sorted({(r["__mix_slot"], r.source or "", r["__mix_phase"], r["__mix_block"], r["__mix_release"], r["__mix_deadline"]) for r in out})
    assert [b[0] for b in blocks] == list(range(len(blocks)))  # one block per slot
    assert all(release <= slot < due for slot, *_, release, due in blocks)
    left = {s: -(-n // 4) for s, n in {**sizes, "a": 122}.items()}
    own = {"a": 5, "b": 3, "c": 2, "": 2}
    for phase in sorted({b[2] for b in blocks}):
        active = {s for s, n in left.items() if n}
        total, served = sum(own[s] for s in active), dict.fromkeys(active, 0)
        for t, b in enumerate([b for b in blocks if b[2] == phase], 1):
            served[b[1]] += 1
            assert all(abs(served[s] - t * own[s] / total) < 1 for s in active)
        left = {s: n - served.get(s, 0) for s, n in left.items()}
    assert not any(left.values())
    assert mixing.mixed(docs, weights).columns == docs.columns and mixing.mixed(make_docs([]), weights).count() == 0


def brute_period(weights):
    total, used, out = sum(weights), [0] * len(weights), []
    for t in range(total):
        can = [(-(-(used[i] + 1) * total // w), i) for i, w in enumerate(weights) if used[i] < w and used[i] * total // w <= t]
        out.append(min(can)[1])
        used[out[-1]] += 1
    return out


@pytest.mark.parametrize("weights", [[1], [6, 3, 3, 2], [1] * 9, [5, 1, 1, 7, 2, 2], [40, 1, 1, 1, 33]])
def test_a_period_is_served_by_earliest_deadline(weights):
    slots = mixing.serve_period(weights)
    assert [next(i for i, s in enumerate(slots) if t in s) for t in range(sum(weights))] == brute_period(weights)


def test_mix_passes_any_columns_through(spark):
    rows = [(k, f"s{k % 3}", "p", "part", k, "at", "base", "phases", {"m": k}, "x`y") for k in range(40)]
    names = "doc_id long, source string, p string, part string, j long, `at` string, base string, phases string, __mix_at map<string,long>, `a``b` string"
    docs = spark.createDataFrame(rows, names)
    for out in (mixing.mixed(docs, {"s0": 2}, block_rows=3), mixing.interleave(docs, {"s0": 2}, block_rows=3).select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])):
        assert out.dtypes == docs.dtypes and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    with pytest.raises(ValueError):
        mixing.mixed(docs.withColumn("__mix_slot", F.lit(1)), {})


def test_mix_of_very_many_sources(spark):
    docs = spark.range(15_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("h"), F.col("id") % 5_000).alias("source"))
    out = mixing.interleave(docs, {"h7": 5000, "h11": 200_000}, block_rows=1).select("source", "__mix_slot").collect()
    assert sorted(r["__mix_slot"] for r in out) == list(range(15_000))


def paths(spark, rows, branches):
    tree = spark.createDataFrame(rows, "conv_id bigint, node bigint, parent bigint, role string, text string, score double, extra int")
    out = chat.format_trees(tree, branches).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("learned", chat.loss_texts(F.col("formatted"), F.col("loss")))
    return {(r.conv_id, r.branch): ([(t.role, t.text) for t in r.turns], r.learned, r.path_score) for r in out.collect()}


def test_reply_trees(spark):
    nasty = "\\### \\\\ </turn>\n### assistant: \\h \\t \\c ####"
    rows = [(1, 1, None, "user", "q", 0.0, 0), (1, 2, 1, "assistant", nasty, 2.0, 0), (1, 3, 1, "assistant", "b", 1.0, 0), (1, 4, 3, "user: x", "c", 5.0, 0),
            (2, 9, 77, None, None, None, 0), (3, 1, 2, "user", "cycle", 1.0, 0), (3, 2, 1, "user", "cycle", 1.0, 0),
            (None, 1, None, "user", "n", 1.0, 0)] + [(4, k, k - 1 if k else None, "user" if k % 2 == 0 else "assistant", f"m{k}", 1.0, 0) for k in range(37)]
    got = paths(spark, rows, 2)
    assert got[1, 1] == ([("user", "q"), ("assistant", "b"), ("user: x", "c")], ["b"], 6.0)
    assert got[1, 2] == ([("user", "q"), ("assistant", nasty)], [nasty], 2.0)
    assert got[2, 1] == ([("", "")], [], 0.0) and got[None, 1][0] == [("user", "n")]
    assert [t for _, t in got[4, 1][0]] == [f"m{k}" for k in range(37)] and got[4, 1][1] == [f"m{k}" for k in range(1, 37, 2)]
    assert not any(c == 3 for c, _ in got) and len(got) == 5 and paths(spark, [], 1) == {}


@pytest.mark.parametrize("url,host,path", [(None, "", ""), ("no scheme/x", "", ""), ("HTTP://A.Com", "a.com", ""), ("x://H?q=/a", "h", ""), ("x://h/p/a#f?", "h", "/p/a"), ("x://É.Com/Ä?", "É.com", "/Ä")])
def test_split_url(spark, url, host, path):
    got = spark.createDataFrame([(url,)], "url string").select(*[c.alias(n) for n, c in zip("hp", urls.split_url(F.col("url")), strict=True)]).first()
    assert tuple(got) == (host, path)


def test_url_templates(spark):
    rules = [("allow", "com", "/"), ("block", "bad.com", "/spam/"), ("block", "net", "/x/"), ("allow", "www.net", "/x/y/")]
    rows = [(k, f"http://bad.com/spam/{k}") for k in range(30)] + [(100 + k, f"http://sub.bad.com/ok/{k}.html") for k in range(30)]
    rows += [(200, "http://www.net/x/y/1"), (201, "http://www.net/x/z"), (202, "http://other.org/" + "a/" * 40), (203, None), (None, "http://notbad.com/spam/1"), (203, None)]
    rows += [(300 + k, f"http://n.net/x/{k}?q") for k in range(40)] + [(400, "http://n.net/x"), (401, "http://n.net/w/7")]
    got = urls.judge(spark.createDataFrame([(*r, "h") for r in rows], "page_id bigint, url string, host string"), rules).collect()
    assert len(got) == len(rows)
    by = {r.page_id: (r.rule, r.verdict) for r in got}
    assert by[3] == ("bad.com/spam/", "block") and by[101] == ("com/", "allow") and by[None] == ("com/", "allow")
    assert by[200] == ("www.net/x/y/", "allow") and by[201] == ("net/x/", "block") and by[202] == (None, "allow") == by[203] and by[401] == (None, "allow")
    assert {r.template for r in got if r.page_id in range(30)} == {"/*/*"} or {r.template for r in got if r.page_id in range(30)} == {"/spam/*"}
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string"), rules).count() == 0


def test_unlabelled_branches_inherit_by_structure(spark):
    """op9's own rules reject pages that none of them fits: those built like the blocked."""
    from tidyrent.llm.queries import URL_RULES

    urls_of = [f"https://shop.net/{lang}/{i}/a{i % 2}.html" for lang in ("es", "fr") for i in range(60)]
    alike = [f"https://shop.net/{lang}/{i}/a{i % 2}.html" for lang in ("de", "pt") for i in range(20)]
    other = [f"https://shop.net/about/team/{i}" for i in range(20)] + ["https://shop.net/", "https://shop.net/de"]
    elsewhere = [f"https://blog.net/{lang}/{i}/a.html" for lang in ("de", "pt") for i in range(20)]
    good = [f"https://shop.com/{i}" for i in range(400)]
    rows = list(enumerate(urls_of + alike + other + elsewhere + good))
    got = {r.url: r for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string"), URL_RULES)
           .join(spark.createDataFrame(rows, "page_id bigint, url string"), "page_id").collect()}
    assert {got[u].rule for u in urls_of} == {"net/es/", "net/fr/"}
    assert {(got[u].rule, got[u].verdict, got[u].template.split("/")[1]) for u in alike} == {(None, "block", "*")}
    assert {(got[u].rule, got[u].verdict) for u in other + elsewhere} == {(None, "allow")}


def test_segments_beyond_the_depth_are_judged(spark):
    deep = "/".join("abcdefgh")
    rows = [(i, f"http://h.x/{deep}/{'bad' if i % 2 else 'good'}/{i}/z") for i in range(80)]
    assert {r.s[-1] for r in spark.createDataFrame(rows, "i int, url string").select(urls.shapes(urls.split_url(F.col("url"))[1]).alias("s")).collect()} == {"bad/{n}/z", "good/{n}/z"}
    rules = [("allow", "h.x", "/"), ("block", "h.x", f"/{deep}/bad/")]
    got = urls.judge(spark.createDataFrame(rows, "page_id int, url string"), rules).collect()
    assert len({r.template for r in got}) == 2


def test_bad_templates_are_rejected_beyond_the_rule(spark):
    rows = [(k, f"http://h.net/a/{k}") for k in range(60)] + [(60 + k, f"http://h.net/b/{k}") for k in range(60)] + [(500, "http://h.net/a/77x")]
    rules = [("block", "net", "/a/1"), ("block", "net", "/a/2"), ("block", "net", "/a/3"), ("allow", "net", "/b/")]
    got = {r.page_id: (r.rule, r.verdict, r.template) for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert got[45] == (None, "block", got[1][2]) and got[61][1] == "allow" and got[45][2] != got[61][2]


def test_language_id_held_out(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    hidden = F.when(F.xxhash64("doc_id") % 3 != 0, F.col("lang"))  # a third of the labels is held out
    out = langid.identify(docs, "text", hidden, F.lit(None), F.col("source")).where("xxhash64(doc_id) % 3 = 0 and n_chars > 20")
    right = out.agg(F.avg((F.col("__lid_lang") == F.col("lang")).cast("double")), F.avg(F.col("__lid_kept").cast("double"))).first()
    assert right[0] >= 0.97 and right[1] >= 0.97


def test_language_evidence_decides_short_texts(spark, make_docs):
    rows = [(k, "the dog and the cat sat on the mat", "en", "x.co.uk") for k in range(30)] + [(100 + k, "der hund und die katze auf der matte", "de", "y.de") for k in range(30)]
    rows += [(200, "on", None, "y.de"), (201, "12 34", "en", "x.co.uk"), (202, None, None, None), (203, "", "de", "y.de")]
    out = {r.doc_id: r for r in langid.identify(make_docs(rows), "text", F.col("lang"), F.lit(None), F.col("source")).collect()}
    assert all(out[k]["__lid_lang"] == ("en" if k < 100 else "de") and out[k]["__lid_kept"] for k in [*range(30), *range(100, 130)])
    assert not out[201]["__lid_kept"] and not out[202]["__lid_kept"] and not out[203]["__lid_kept"] and out[203]["__lid_lang"] == "de"
    assert langid.identify(make_docs([]), "text", F.col("lang"), F.lit(None), F.col("source")).count() == 0
    bare = langid.identify(make_docs([(1, "x y", None, None)]), "text", F.col("lang"), F.lit(None), F.col("source")).collect()
    assert [(r["__lid_lang"], r["__lid_kept"]) for r in bare] == [(None, False)]
    assert json.dumps(sorted(out[1].asDict())).count("__lid") == 3


def test_text_model_takes_each_text_once_and_few(spark, make_docs):
    rows = [(k, "aaaa", "en", "a") for k in range(500)] + [(1000 + k, f"b{k:04d}", "en", "a") for k in range(400)] + [(5000, "cccc", "de", "a")]
    labelled = make_docs(rows)
    langs, model = langid.fit(labelled, "text", F.col("lang"), per_language=1000)
    counts = np.exp(model)
    own = langid._codes("aaaa")
    assert langs == ["de", "en"]
    assert np.isclose(counts[1, own[1]], 2.5 / (0.5 * langid.BUCKETS + 4 + 400 * 5), rtol=1e-3)  # 500 copies teach once
    few = np.exp(langid.fit(labelled, "text", F.col("lang"), per_language=10)[1])
    total = 0.5 / few[1].min() - 0.5 * langid.BUCKETS  # trigrams that the ten texts gave
    assert 10 * 5 - 1.5 <= total <= 10 * 5 + 0.5


def test_texts_in_no_known_language_are_rejected(spark, small_dir):
    known = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = np.random.default_rng(1)
    noise = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 5)) for _ in range(60))
    foreign = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era "
               "e cosa dura esta selva selvaggia e aspra e forte che nel pensier rinova la paura",
               "Litwo, Ojczyzno moja! ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej "
               "ozdobie widzę i opisuję, bo tęsknię po tobie", "Мой дядя самых честных правил, когда не в шутку занемог, он уважать себя заставил", noise]
    rows = spark.createDataFrame([(-1 - k, t, None, "src0", len(t)) for k, t in enumerate(foreign)], known.schema)
    out = langid.identify(known.unionByName(rows), "text", F.col("lang"), F.lit(None), F.col("source"))
    assert out.where("doc_id < 0 and __lid_kept").count() == 0
    assert out.where("doc_id >= 0 and n_chars > 20").agg(F.avg(F.col("__lid_kept").cast("double"))).first()[0] >= 0.99


def _by_hand(rows, langs, model, limits):
    """Posteriors of (id, text, declared, host) rows, one by one, from the text model."""
    n, s, mixture = len(langs), langid.SMOOTHING, langid._mixture(model)

    def text_of(t):
        if t is None or not any(map(str.isalpha, t)):
            return None, None
        codes = langid._codes(t)
        own = codes[langid._of_letters(t)]
        mean = model[:, codes].astype(np.float64).mean(axis=1) * min(langid.EVIDENCE, len(codes))

        def fits(k):
            middle, deviation, single = limits[k]
            return not len(own) or mixture[own].astype(np.float64).mean() >= middle - langid.LIMIT * np.sqrt(deviation**2 + single**2 / len(own))

        return mean, fits

    texts = [text_of(t) for _, t, _, _ in rows]
    votes = [(host, said, int(np.argmax(x))) for (x, fits), (_, _, said, host) in zip(texts, rows, strict=True) if x is not None and fits(int(np.argmax(x)))]

    def among(test):
        return np.bincount([g for h, d, g in votes if test(h, d)], minlength=n).astype(float)

    base = among(lambda h, d: h is not None)
    base = (base + 1) / (base.sum() + n)
    said_all = among(lambda h, d: d is not None)
    out = {}
    for (i, _, said, host), (x, fits) in zip(rows, texts, strict=True):
        total = np.zeros(n) if x is None else x.copy()
        if host is not None and any(h == host for h, _, _ in votes):
            prior = base
            for depth in (1, 2, 99):
                key = host.split(".")[-depth:]
                c = among(lambda h, d, key=key, depth=depth: h is not None and h.split(".")[-depth:] == key)
                prior = (c + s * prior) / (c.sum() + s)
            total += np.log(prior)
        c = among(lambda h, d: d == said) if said is not None else np.zeros(n)
        if c.sum():
            total += np.log((c + s * c.sum() / said_all.sum()) / (said_all + s))
        p = 1 / np.exp(total - total.max()).sum()
        k = int(np.argmax(total))
        out[i] = (langs[k], p, x is not None and p >= langid.MIN_POSTERIOR and bool(fits(k)))
    return out


def test_posteriors_against_brute_force(spark, small_dir, make_docs):
    some = spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").limit(150).collect()
    cuts, hosts, said = [0, 3, 9, 40, 100_000], ["a.x.co", "b.x.co", "c.de", "d", None], {0: None, 1: "zz", 2: "qq"}
    rows = [(k, None if r.text is None else r.text[: cuts[k % 5]], said.get(k % 7, r.lang), hosts[(k * 7 + len(r.lang or "")) % 5]) for k, r in enumerate(some)]
    docs = make_docs(rows)
    langs, model, limits = langid.fit_with_limits(docs, "text", F.col("lang"))
    assert {"zz", "qq"} <= set(langs)
    expected = _by_hand(rows, langs, model, limits)
    got = {r.doc_id: r for r in langid.identify(docs, "text", F.col("lang"), F.lit(None), F.col("source")).collect()}
    for i, (lang, p, kept) in expected.items():
        assert np.isclose(got[i]["__lid_posterior"], p, rtol=1e-6), (i, got[i], expected[i])
        assert p < 0.5 + 1e-6 or got[i]["__lid_lang"] == lang
        assert abs(p - langid.MIN_POSTERIOR) < 1e-6 or got[i]["__lid_kept"] == kept


def test_more_than_64_labels(spark, make_docs):
    rng = np.random.default_rng(5)
    labels = [a + b for a in "abcdefghi" for b in "klmnopqr"][:70]
    words = {x: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(30)] for x in labels}
    rows = [(100 * k + j, " ".join(rng.choice(words[x], 25)), x if j < 9 else None, None) for k, x in enumerate(labels) for j in range(12)]
    rows += [(10_000 + j, " ".join(rng.choice(words["ak"], 25)), "ak", None) for j in range(400)]  # a label that holds a third of all rows
    got = langid.identify(make_docs(rows), "text", F.col("lang"), F.lit(None), F.col("source")).where("doc_id < 10000").collect()
    right = [r["__lid_lang"] == labels[r.doc_id // 100] for r in got]
    assert len(got) == 840 and np.mean(right) > 0.98 and np.mean([r["__lid_kept"] for r in got]) > 0.95


def test_country_suffixes_each_count_for_themselves(spark):
    votes = [("at", 0, 90), ("mx", 1, 90), ("uk", 2, 90), ("uk", 0, 10)]
    df = spark.createDataFrame(votes, "address string, guess int, n bigint")
    got = {r.address: np.exp(r.evidence) for r in langid.likelihoods(df, "address", ["de", "es", "en"]).collect()}
    assert [int(np.argmax(got[c])) for c in ("at", "mx", "uk")] == [0, 1, 2]
    assert np.isclose(got["uk"][0], (10 + 8 * 100 / 280) / 108) and np.allclose(sum(got.values()), 1)


def test_language_of_pages(spark, small_dir):
    from tidyrent.llm import queries

    rows = queries.op5_language_id(spark, small_dir)
    pages = rows.where("page_id is not null").collect()
    assert len(pages) == spark.read.parquet(f"{small_dir}/pages.parquet").count() and all(r.doc_id is None for r in pages)
    known = [r for r in pages if r.declared and r.kept]
    assert known and np.mean([r.language == r.declared[:2].lower() for r in known]) > 0.9


def test_every_labelled_text_is_fitted(spark, make_docs):
    word = lambda k: "".join(chr(97 + int(c)) for c in f"{k:05d}")
    rows = [(k, word(k), "en", "a") for k in range(2500)] + [(9000 + k, word(7), "en", "a") for k in range(30)] + [(5000, "cccc", "de", "a")]
    langs, model, limits = langid.fit_with_limits(make_docs(rows), "text", F.col("lang"))
    counts = np.zeros(langid.BUCKETS)
    for text in {t for _, t, lang, _ in rows if lang == "en"}:
        counts += np.bincount(langid._codes(text), minlength=langid.BUCKETS)
    assert langs == ["de", "en"] and np.allclose(model[1], langid._logs(counts), atol=1e-5)
    assert np.isfinite(limits[1]).all()
