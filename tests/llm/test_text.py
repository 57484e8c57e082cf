"""Toxicity, quality, secrets, chat formatting, url rules, packing, decontamination."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import chatfmt, decontam, packing, quality, queries, secretscan, toxicity, urlfilter

from siltworks.llm.common import stage

SF = "/root/testdata/sf0.01"


def test_fold_reads_homoglyphs_and_digits():
    assert toxicity.fold("ІDIОT 1d1ot id​iot 2024") == " idiot idiot idiot 2024 "
    assert toxicity.fold("") == "  "


def test_matcher_counts_terms_but_not_inside_exceptions():
    hits = toxicity.matcher(toxicity.Lexicon({"thorp": 2.0, " bad ": 1.0}, (" scunthorpe ",)))
    assert hits(toxicity.fold("Scunthorpe")) == (0.0, 1)
    assert hits(toxicity.fold("thorps bad badly")) == (3.0, 3)
    assert toxicity.matcher(toxicity.Lexicon({}))("  ") == (0.0, 0)


def test_matcher_is_linear_in_hits_and_equals_all_pairs():
    import time

    rng = random.Random(8)
    lexicon = toxicity.Lexicon({"ab": 1.0, "b a": 2.0, " cab ": 3.0}, (" ab ", "b ab c", "cabs"))
    for _ in range(200):
        text = toxicity.fold(" ".join(rng.choice(["ab", "cab", "cabs", "b", "abc", "c"]) for _ in range(20)))
        found = lambda words: sorted((e + 1, k) for k, w in enumerate(words) for e in range(len(text)) if text.startswith(w, e + 1 - len(w)) and e + 1 >= len(w))
        masks = [(e - len(lexicon.exceptions[k]), e - 1) for e, k in found(lexicon.exceptions)]
        got, words = toxicity.matcher(lexicon)(text)
        terms, total, last = list(lexicon.terms.items()), 0.0, -1
        for e, k in sorted(found([t for t, _ in terms]), key=lambda x: (x[0], -len(terms[x[1]][0]))):
            a = e - len(terms[k][0])
            if a > last and not any(x <= a and e - 1 <= y for x, y in masks):
                total, last = total + terms[k][1], e - 2
        assert (got, words) == (total, 20)
    began = time.time()
    toxicity.matcher(lexicon)(" cabs ab " * 400_000)
    assert time.time() - began < 20


def test_toxicity_finds_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n.get((1, 1), 0) / (n.get((1, 1), 0) + n.get((1, 0), 0)) >= 0.85
    assert n.get((0, 1), 0) / n[0, 0] <= 0.02
    assert docs.count() == 10_000


def test_toxicity_edge_rows(spark):
    rows = spark.createDataFrame([(1, None, 0), (2, "", 0), (2, "", 0), (None, "scum", 0)], "doc_id long, text string, score int")
    got = toxicity.toxicity_scores(rows, toxicity.Lexicon({" scum ": 5.0}, (), (-3.0, 2.0, 1.0))).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and [r.score >= 0.5 for r in got if r.doc_id is None] == [True]
    assert toxicity.drop_toxic(rows, toxicity.Lexicon({})).columns == ["doc_id", "text", "score"]
    assert toxicity.toxicity_scores(rows.where("false"), toxicity.Lexicon({})).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(toxicity.sample_of(rows, none)).terms == {}


def brute_model(texts):
    """Log probabilities of a text's symbols under the model, straight from its definition."""
    order, size = quality.ORDER, quality.SYMBOLS
    chars = [c for c, _ in sorted(Counter("".join(texts)).items(), key=lambda x: (-x[1], ord(x[0])))][: size - quality.FIRST]
    code = {c: k for k, c in enumerate(chars, quality.FIRST)}
    symbols = lambda t: [0] * (order - 1) + [code.get(c, quality.UNKNOWN) for c in t.lower()] + [quality.END]
    counts = {order: Counter()}
    for t in texts:
        s = symbols(t)
        counts[order].update(tuple(s[k : k + order]) for k in range(len(s) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off, total, back = {}, {}, {}
    for k, c in counts.items():
        of = Counter(c.values())
        off[k] = quality.discounts(*(of[n] for n in (1, 2, 3, 4)))
        for g, n in c.items():
            total[g[:-1], k] = total.get((g[:-1], k), 0) + n
            back[g[:-1], k] = back.get((g[:-1], k), 0) + off[k][min(n, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / (size - 1)
        low, t = p(g[1:]), total.get((g[:-1], k))
        if not t:
            return low
        n = counts[k][g]
        return (n - off[k][min(n, 3) - 1] if n else 0) / t + back[g[:-1], k] / t * low

    def perplexity(text):
        s = symbols(text)
        logs = [math.log(p(tuple(s[k : k + order]))) for k in range(len(s) - order + 1)]
        return math.exp(-sum(logs) / len(logs))

    return perplexity


def test_quality_model_equals_its_definition(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "ring", "thing", "Then", "bring", "é"]) for _ in range(20)) for _ in range(30)]
    trusted = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model, want = quality.train(trusted), brute_model([t.lower() for t in texts])
    rows = [(1, texts[0], "en"), (2, "", "en"), (3, None, None), (4, "zzz ### 日本😀", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, None), (9, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.perplexity_filter(docs, labels, model).collect()}
    for d, t, _ in rows:
        assert got[d].perplexity == pytest.approx(want(t or ""), rel=1e-3)
    assert quality.perplexity_filter(docs.where("false"), labels, model).count() == 0


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_quality_tells_rare_scripts_from_noise(spark, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    monkeypatch.setattr(quality, "SEGMENT", block)
    rng = random.Random(5)
    large = [chr(0x4E00 + k) for k in range(150)]
    small = ["ⴰⴱⴳ", "ⴷⴹⴻⴼ", "ⴽⵀⵃⵄ", "ⵅⵇⵉ", "😀𐐨"]
    texts = ["".join(rng.choices(large, k=400)) for _ in range(30)] + [" ".join(rng.choices(small, k=15)) for _ in range(30)]
    good, noise = " ".join(rng.choices(small, k=15)), "".join(rng.sample("".join(small) * 6, 75))
    model = quality.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    docs = spark.createDataFrame([(1, good, "zgh"), (2, noise, "zgh"), (3, "", None), (4, None, "a"), (5, texts[0] + "unseen", "zh"), (5, good, "zgh")], "doc_id long, text string, lang string").repartition(2)
    got = sorted((r.doc_id, r.perplexity) for r in quality.perplexity_filter(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), model).collect())
    monkeypatch.setattr(quality, "SYMBOLS", quality.FIRST + len({*"".join(texts)}))
    want = brute_model(texts)
    cases = [(1, good), (2, noise), (3, ""), (4, ""), (5, texts[0] + "unseen"), (5, good)]
    assert got == [(d, pytest.approx(p, rel=1e-9)) for d, p in sorted((d, want(t)) for d, t in cases)]
    assert got[1][1] > 3 * got[0][1]


def test_quality_grams_of_any_alphabet_are_exact():
    texts = ["".join(map(chr, [*range(0x3400, 0xD800), *range(0xE000, 0xFFFF), *range(0x20000, 0x28000)])), "ab", ""]
    contexts, symbols, which, lengths = quality._grams(texts)
    want = [s for t in texts for x in [[0] * 3 + [ord(c) + 3 for c in t.lower()] + [1]] for s in zip(x, x[1:], x[2:], x[3:], strict=False)]
    assert [(int(contexts[w]) >> 42, int(contexts[w]) >> 21 & 0x1FFFFF, int(contexts[w]) & 0x1FFFFF, int(symbols[w])) for w in which] == want
    assert [*lengths] == [len(t) + 1 for t in texts]


def test_quality_keeps_clean_and_drops_junk(spark):
    got = queries.op2_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n = {(r.quality, r.kept): r["count"] for r in got.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert got.count() == 1000 and n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97 and n[0, False] > n.get((0, True), 0)


def test_secrets(spark):
    model = secretscan.fit(secretscan.labelled_findings(spark))
    hexes = hashlib.sha1(b"1").hexdigest()
    rows = [(1, f'then token = "{hexes}" ends', "src0"), (2, f"commit {hexes} fixes", "src0"), (3, "card 4785380592391139 paid", "src0"), (4, None, None), (5, "", ""), (6, "x" * 300_000 + f" password={hexes[:18]}", "src1"), (6, f"password={hexes[:18]}", "src1")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, length double")
    got = [(r.doc_id, r.value, r.is_secret) for r in secretscan.scan(docs, model).collect()]
    assert sorted(got) == sorted([(1, hexes, True), (2, hexes, False), (3, "4785380592391139", False), (6, hexes[:18], True), (6, hexes[:18], True)])
    held = secretscan.with_features(secretscan.labelled_findings(spark, 6_000).where("id >= 4000"))
    from pyspark.ml.feature import VectorAssembler

    out = model.transform(VectorAssembler(inputCols=list(secretscan.FEATURES), outputCol="features").transform(held))
    assert out.where("label = prediction").count() / held.count() > 0.97
    assert secretscan.scan(docs.where("false"), model).count() == 0


def test_secret_candidates_of_every_shape(spark):
    rng = random.Random(6)
    base32, letters, alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    made = lambda n, a: "".join(rng.choices(a, k=n))
    shapes = [lambda: ("the key ", "AKIA" + made(16, base32)), lambda: ("auth bearer ", made(20, alnum)), lambda: ("value ", "ghp_" + made(36, letters)), lambda: ("x=", made(24, letters) + "==")]
    cases = [rng.choice(shapes)() for _ in range(300)]
    cases += [('"password": "', "hunterhunter"), ('{"api_key": "', "abcdefghijkl"), ("pwd=", "correcthorse"), ("client_secret_key=", "abcdefghijklm"), ('password: "', "p@ssw0rd!xyz"), ("Credential := '", "two words\\E too"), ("token   =    ", "aBcD!234")]
    docs = spark.createDataFrame([(k, f"so {b}{v}{q} ends", "src0") for k, (b, v) in enumerate(cases) for q in ["'" if b[-1] == "'" else '"' if b[-1] == '"' else ""]], "doc_id long, text string, source string")
    got = {(r.doc_id, r.value) for r in secretscan.candidates(docs).collect()}
    assert {(k, v) for k, (_, v) in enumerate(cases)} <= got
    judged = {(r.doc_id, r.value): r.is_secret for r in secretscan.scan(docs, secretscan.fit(secretscan.labelled_findings(spark))).collect()}
    missed = [c for k, c in enumerate(cases) if not judged[k, c[1]]]
    assert len(missed) <= 0.05 * len(cases), missed


def planted_findings():
    """(text, value, is a secret): sentences with values drawn at random or written by hand. Not independent of the scanner: its words (token, checksum, password), one prefix (glpat-) and the placeholders' words are in its lists, too."""
    r = random.Random(11)
    draw = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alnum, rows = lower + upper + digits, []
    for _ in range(40):
        for text, value, y in (
            ("export AWS_SECRET_ACCESS_KEY={} before the build", draw(alnum + "/+", 40), 1),
            ("The client sends 'Authorization: Bearer {}' with it", draw(alnum, 43), 1),
            ('{{"db": {{"passwd": "{}"}}}}', draw(alnum + "!#%&*", 14), 1),
            ("curl https://example.org -H x-id:{} works", "glpat-" + draw(alnum, 20), 1),
            ("He wrote {} is our new token on the board", draw(alnum, 32), 1),
            ("git checkout {} and build", draw("abcdef" + digits, 40), 0),
            ("The archive has {} as its checksum", draw("abcdef" + digits, 64), 0),
            ("see urn:uuid:{} for the record", "-".join(draw("abcdef" + digits, n) for n in (8, 4, 4, 4, 12)), 0),
            ("call {} in the handler", r.choice(["getUserAccountSettings", "initializeDatabaseConnection", "org/apache/commons/lang", "parse_configuration_file"]), 0),
            ("Die {} tagt heute", r.choice(["Bundesverfassungsrichterin", "Gesundheitsministerkonferenz", "Verkehrsinfrastrukturgesellschaft"]), 0),
            ("password: {} until you set one", r.choice(["changeme_example", "your_password_here", "<insert-password>", "example_password"]), 0),
            ("tracked as parcel no {} since May", draw(digits, 18), 0),
        ):
            rows.append((text.format(value), value, y))
    return rows


def test_planted_secrets_are_found_and_harmless_values_left(spark):
    rows = planted_findings()
    docs = spark.createDataFrame([(k, t, "notes") for k, (t, _, _) in enumerate(rows)], "doc_id long, text string, source string")
    judged = {(r.doc_id, r.value): r.is_secret for r in secretscan.scan(docs, secretscan.fit(secretscan.labelled_findings(spark))).collect()}
    told = [(y, judged.get((k, v), False)) for k, (_, v, y) in enumerate(rows)]
    hits, false, real = sum(y and t for y, t in told), sum(t and not y for y, t in told), sum(y for y, _ in told)
    by_shape = Counter((k % 12, y) for k, (y, t) in enumerate(told) if bool(y) != t)
    print("recall", hits / real, "precision", hits / (hits + false), by_shape)
    assert hits / real >= 0.9 and hits / (hits + false) >= 0.9, by_shape


def test_secret_words_behind_a_value_count(spark):
    value = "k3" + "Qz7pLm2X" * 3
    docs = spark.createDataFrame([(1, f"so {value} is the checksum, and {value} is the password now"), (2, f"at {value} is its checksum"), (3, value)], "doc_id long, text string")
    got = {r.doc_id: (r.before[-3:], r.after[:16], r.occurrences) for r in secretscan.candidates(docs, path_col=None).collect()}
    assert got == {1: ("nd ", " is the password", 2), 2: ("at ", " is its checksum", 1), 3: ("", "", 1)}


def test_secret_is_judged_by_its_most_telling_place(spark):
    value = hashlib.sha1(b"2").hexdigest()
    rows = [(1, f"commit {value} has token={value} and commit {value}"), (2, f"commit {value} sha1 {value}"), (3, "-" * 100_000 + " undchkeitachkeit tokentoken" * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.value): (r.before[-8:], r.occurrences) for r in secretscan.candidates(docs, path_col=None).collect()}
    assert got == {(1, value): ("s token=", 3), (2, value): ("commit ", 2), (3, "undchkeitachkeit"): ("entoken ", 3)}


def test_chat_round_trip(spark):
    rows = [(1, 2, "assistant", "&lt; <turn> & </turn>\n"), (1, 0, "us\ner<", None), (1, 2, "assistant", "&lt; <turn> & </turn>\n"), (2, None, None, "x"), (2, 0, "assistant", ""), (None, 0, "user", "é😀")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    out = chatfmt.format_conversations(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.select("conv_id", chatfmt.parse(F.col("formatted")).alias("turns")).collect()}
    assert back == {1: [("us\ner<", ""), *[("assistant", "&lt; <turn> & </turn>\n")] * 2], 2: [("", "x"), ("assistant", "")], None: [("user", "é😀")]}
    d = {r.conv_id: r for r in chatfmt.digests(out).collect()}
    text = 2 * "&lt; <turn> & </turn>\n"
    assert d[1].loss_chars == len(text) and d[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and d[1].n_turns == 3
    assert chatfmt.digests(chatfmt.format_conversations(df.where("false"))).count() == 0


def test_events_fold(spark):
    e = [(1, "message", 1, "user", "hi"), (2, "message", 2, "assistant", "A"), (3, "delta", 2, None, "B"), (4, "edit", 1, None, "hello"), (5, "regenerate", 2, None, None), (6, "message", 2, "assistant", ""), (7, "delta", 2, None, "C"), (8, "delta", 2, None, "D"), (9, "noise", 2, "x", "x"), (10, "delta", 3, None, None)]
    df = spark.createDataFrame([(1, *x) for x in e], "conv_id long, seq long, event string, message long, role string, text string").repartition(3)
    got = sorted(tuple(r)[1:] for r in chatfmt.fold_events(df).collect())
    assert got == [(1, "user", "hello"), (2, "assistant", "CD"), (3, "", "")]


def test_url_rules(spark):
    urls = ["http://a.net/x", "http://EXAMPLE.net/en/1", "http://m.example.net/en", "https://x.example.com/de/2?q", "http://x.org/fr/", "http://x.org/FR/", "http://a.net?x", "net/", None, "://", "http://a.network/", "http://ads.doubleclick.net/z", "http://q.io/banner-ads/1#a", "ftp://u@h.net:80/p"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(df, named=urlfilter.HOST_RULES).collect()}
    allow, none = "allow", (None, "allow")
    assert got == {0: ("net/", "block"), 1: ("example.net/en/", allow), 2: ("net/", "block"), 3: ("example.com/de/", "block"), 4: ("org/fr/", allow), 5: none, 6: none, 7: none, 8: none, 9: none, 10: none, 11: ("net/", "block"), 12: (None, "block"), 13: none}
    assert urlfilter.judge_urls(df.where("false")).count() == 0


def test_url_index_equals_all_rules():
    rng = random.Random(1)
    parts = ["a", "ab", "b", "net", "x1"]
    rules = tuple(urlfilter.Rule(p, "block", p) for p in {rng.choice(["", "||"]) + "".join(rng.choice(parts + ["*", "^", "/", "."]) for _ in range(rng.randrange(1, 6))) for _ in range(150)})
    index, rest = urlfilter.build_index(rules)
    for _ in range(400):
        url = ".".join(rng.choice(parts) for _ in range(2)) + "/" + "".join(rng.choice(parts + ["/", "-", "."]) for _ in range(5))
        found = {e[1][2] for t in {*urlfilter._TOKEN.findall(url)} for e in index.get(t, ()) if e[0].match(url)} | {e[1][2] for e in rest if e[0].match(url)}
        assert found == {r.name for r in rules if urlfilter.compiled(r.pattern).match(url)}


def best_fit(lengths, capacity):
    rooms, out = [], []
    for n in sorted(lengths, reverse=True):
        fit = [(r, k) for k, r in enumerate(rooms) if r >= n]
        k = min(fit)[1] if fit else len(rooms)
        rooms += [capacity] * (k == len(rooms))
        rooms[k] -= n
    return len(rooms), out


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_as_many_bins_as_one_by_one(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, rng.choice([5, 40, 100])) for _ in range(300)]
    runs = packing.best_fit_plan(Counter(lengths).items(), 100)
    places = [(n, b + k // each, o + k % each * n) for n, lo, hi, b, each, o in runs for k in range(hi - lo)]
    assert Counter(n for n, _, _ in places) == Counter(lengths)
    bins = {}
    for n, b, o in places:
        bins.setdefault(b, []).append((o, n))
    for own in bins.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 100
    assert len(bins) == best_fit(lengths, 100)[0]


@pytest.mark.parametrize("plan_rows", [200_000, 0])
def test_packing_whole_table(spark, monkeypatch, plan_rows):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "PLAN_ROWS", plan_rows)
    file = queries.tokenizer_file()
    t = Tokenizer.from_file(file)
    rng = random.Random(2)
    texts = ["", None, "İstanbul ΟΔΟΣ it's 12 <|endoftext|> x\x85z\x1cq é \t tab 日本 ½² 'll 'S", *("".join(rng.choice("ab'stre ,.é\n\tÉ1²<|>😀ſßİǅ") for _ in range(80)) for _ in range(150)), "word " * 5000]
    df = spark.createDataFrame([(k, x, 1, "l") for k, x in enumerate(texts)], "doc_id long, text string, length int, offset string")
    rows = packing.pack(packing.token_pieces(df, file, keep_ids=True)).collect()
    own = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(own.setdefault(r.doc_id, b"")) // 4 and r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        own[r.doc_id] += bytes(r.ids)
    for k, x in enumerate(texts):
        assert own[k] == np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) == best_fit([r.length for r in rows], 2048)[0]
    assert packing.pack(packing.token_pieces(df.where("false"), file)).count() == 0


def leaks_brute(docs, items):
    import regex

    words = lambda t: regex.findall(r"(?V1)[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[[\p{L}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]]+", (t or "").lower())
    out = set()
    for d, t in docs:
        w = words(t)
        for i, x in items:
            own = words(x)
            n = min(len(own), decontam.WINDOW)
            if len(own) < decontam.SPAN:
                if own and (own == w if len(own) < decontam.RUN else any(own == w[b : b + n] for b in range(len(w) - n + 1))):
                    out.add((d, i))
                continue
            for a in range(len(own) - n + 1):
                if any(sum(p == q for p, q in zip(own[a : a + n], w[b : b + n], strict=True)) * 100 >= decontam.PERCENT * n for b in range(len(w) - n + 1)):
                    out.add((d, i))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(k, " ".join(make(rng.choice([7, 8, 12, 13, 40])))) for k in range(20)] + [(99, None), (98, "a b"), (97, "one"), (96, "where do they all go"), (95, ""), (94, "東京は日本の首都である都市"), (93, "สวัสดีชาวโลก")]
    docs = []
    for d in range(120):
        own = items[rng.randrange(20)][1].split()
        cut = own[rng.randrange(len(own)) :][: rng.choice([10, 13, 20, 40])]
        for k in rng.sample(range(len(cut)), min(len(cut), rng.randrange(5))):
            cut[k] = "changed"
        docs.append((d, " ".join(make(20) + cut + make(9)).upper()))
    docs += [(200, None), (201, ""), (202, items[1][1]), (203, "A, b!"), (204, "a b c"), (205, "so where do they all go now"), (206, "where do they go"), (207, "前に東京は日本の首都である町だ"), (208, "one"), (202, "other text"), (None, items[4][1]), (None, "x " + items[5][1]), (None, "clean")]
    docs += [(209, " ".join(["filler"] * 30_000 + [items[6][1]] + ["filler"] * 30_000)), (209, items[7][1])]
    df, bench = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id long, text string, seed string, item_id int"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()} == leaks_brute(docs, items)
    rows = decontam.contaminated(df, bench).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows if r.contaminated} == {d for d, _ in leaks_brute(docs, items)} >= {203, 205, 207, 208, 209, None}
    assert decontam.drop_contaminated(df, bench).columns == df.columns
    assert decontam.contaminated(df, bench.where("false")).where("contaminated").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    base = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")
    docs = base
    for k, (name, step) in enumerate(p.STAGES[:-1]):
        docs = stage(step(spark, docs, SF), name)
        assert docs.columns == base.columns, name
    texts = [r.text for r in docs.collect()]
    assert len(texts) == len({*texts}) > 100
    packed = p.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_equals_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_dedup import near_brute

    rng = random.Random(11)
    make = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    item = " ".join(make(20))
    texts = [" ".join(make(rng.randrange(8, 60))) for _ in range(60)]
    toxic = [" ".join(make(10) + ["scumbag", "vermin"] + make(5)) for _ in range(24)]
    near = [" ".join([*texts[k].split(), "tail"]) for k in range(0, 60, 6)]
    copies = texts[1:60:9] + texts[1:60:20]
    leaks = [" ".join(make(15)) + " " + item + " " + " ".join(make(9)), "x " + item.replace(item.split()[4], "changed", 1)]
    rows = list(enumerate(texts + toxic + near + copies + leaks + ["", None, ""]))
    labels = [(k, 1, int(len(texts) <= k < len(texts) + len(toxic))) for k, _ in rows[:84]]
    for name, data, schema in (("documents", [(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, item)], "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(2).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    lexicon = queries.fitted_lexicon(spark, docs, str(tmp_path))
    hits = toxicity.matcher(lexicon)
    clean = [(k, t) for k, t in rows if toxicity.score(lexicon.coef, *hits(toxicity.fold(t or ""))) < 0.5]
    assert {k for k, _ in rows} - {k for k, _ in clean} == set(range(60, 84))
    last = {t or "": k for k, t in clean}
    one = [(k, t) for k, t in clean if last[t or ""] == k]
    apart = near_brute(one, 80, 5)
    kept = [(k, t) for k, t in one if apart[k][1] == k]
    leaked = {d for d, _ in leaks_brute(kept, [(1, item)])}
    assert len(clean) > len(one) > len(kept) and len(leaked) == 2
    assert got == {k for k, _ in kept} - leaked
