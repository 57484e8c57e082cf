"""Relational operators against brute force and inline cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks import sources, streaming
from siltworks.functions import code
from siltworks.operators import dedup, documents, guard, history, pairing, scoring, split, turns


def loop_dedup(rows, cap):
    seen, counts, out = set(), Counter(), {}
    for seq, m, s, exempt in sorted(rows):
        if m in seen:
            out[seq] = "exact"
        elif s is not None and not exempt and cap != -1 and counts[s] >= cap:
            out[seq] = "capped"
        else:
            counts[s] += s is not None and not exempt and cap != -1
            seen.add(m)
            out[seq] = "keep"
    return out


@pytest.mark.parametrize("cap", [-1, 0, 1, 2])
def test_ordered_dedup_equals_the_loop(spark, cap):
    rng = random.Random(cap)
    shapes = [[rng.choice([None, 1, 2]) for _ in range(6)] for _ in range(40)]  # a message has one shape
    cases = [[(k, m := rng.randrange(6), of[m], rng.random() < 0.3) for k in range(14)] for of in shapes]
    rows = [(100 * c + k, f"{c}-{m}", None if s is None else f"{c}-{s}", e) for c, case in enumerate(cases) for k, m, s, e in case]
    df = spark.createDataFrame(rows, "seq long, m string, s string, e boolean")
    got = {r.seq: r.verdict for r in dedup.ordered_dedup(df, "seq", "m", "s", "e", cap).collect()}
    want = {}
    for c in range(len(cases)):
        want |= loop_dedup([r for r in rows if r[0] // 100 == c], cap)
    assert got == want


def test_guard_families_and_groups(spark):
    unit = "function Clamp (V, Lo, Hi : Integer) return Integer is (if V < Lo then Lo else Hi);"
    sigs = guard.signatures(spark.createDataFrame([(unit,), ("",)], "c string"), "c")
    assert {r.family for r in sigs.collect()} == {"exact", "structural"}
    fence = lambda x: f"text\n```ada\n{x}```"
    renamed = re.sub("Clamp|V|Lo|Hi", lambda m: "Q" + m[0], unit)
    rows = [(1, "g1", fence(unit)), (2, "g1", "clean"), (3, "g2", fence(renamed)), (4, "g3", fence(unit.replace("<", ">"))), (5, "g4", unit)]
    df = spark.createDataFrame(rows, "id int, g string, t string")
    hit = guard.blocked_by_code(df, sigs, "id", "t")
    assert sorted(tuple(r) for r in hit.collect()) == [(1, "code:exact"), (1, "code:structural"), (3, "code:structural")]
    assert sorted(r.id for r in guard.drop_groups(df, hit, "id", "g").collect()) == [4, 5]


def test_containment_equals_all_pairs(spark):
    rng = random.Random(2)
    w = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(n))
    prompts = [w(rng.randrange(2, 14)) for _ in range(25)] + ["short", ""]
    texts = [w(10) + " " + rng.choice(prompts).upper() + "x" * rng.randrange(2) + " " + w(10) for _ in range(60)]
    t, p = spark.createDataFrame(list(enumerate(texts)), "id int, t string"), spark.createDataFrame([(x,) for x in prompts], "p string")
    got = {(r.id, r.prompt) for r in guard.contains_prompt(t, p, "id", "t", "p").collect()}
    assert got == {(k, q) for k, x in enumerate(texts) for q in prompts if len(q) >= 20 and q in x.lower()}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 30, 50, 100])
def test_seeded_split(spark, n):
    groups = [f"g{k:03}" for k in range(n)]
    order = groups[:]
    random.Random(42).shuffle(order)
    val, test = split.split_sizes(n)
    want = {g: "test" if k < test else "val" if k < test + val else "train" for k, g in enumerate(order)} if n > 2 else dict(zip(order, ("train", "val")))
    df = spark.createDataFrame([(g,) for g in reversed(groups)] * 2, "g string")
    assert {r.g: r.split for r in split.seeded_group_split(df, "g").collect()} == want
    assert n < 3 or min(n - val - test, val, test) >= 1


def test_pairing(spark):
    files = ["a/p.ads", "a/p.adb", "b/p.ads", "b/q.adb", "c/x.ADS", "c/X.ads", "c/x.adb", "d/y.gpr"]
    got = sorted((r.spec, r.impl) for r in pairing.pair_files(spark.createDataFrame([(f,) for f in files], "path string")).na.fill("").collect())
    assert got == [("", "b/q.adb"), ("a/p.ads", "a/p.adb"), ("b/p.ads", ""), ("c/X.ads", ""), ("c/x.ADS", "c/x.adb")]


def plain_bleu(ref, hyp):
    r, h = re.findall(code.SCORE_TOKEN, ref), re.findall(code.SCORE_TOKEN, hyp)
    if not r or not h:
        return 0.0
    logs = 0.0
    for n in range(1, 5):
        a, b = (Counter(tuple(t[k : k + n]) for k in range(len(t) - n + 1)) for t in (r, h))
        logs += math.log((sum((a & b).values()) + 1) / (sum(b.values()) + 1)) if len(h) >= n else math.log(1e-9)
    return (1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h))) * math.exp(logs / 4)


def test_bleu(spark):
    pairs = [("a := b + 1;", "a := b + 1;"), ("a b c d e", "v w x y z"), ("a b c d e f", "a b c"), ("", "x"), ("x", ""), ("x y", "x"), ("if A then B; end if;", "if A then C; end if; -- n")]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "id int, reference string, hypothesis string")
    got = {r.id: r.bleu for r in scoring.bleu(df).collect()}
    assert got == pytest.approx({k: plain_bleu(*p) for k, p in enumerate(pairs)}) and got[0] == pytest.approx(1) and got[1] < 0.3


def test_bleu_without_grams_as_rows(spark):
    """Texts of all lengths, copies, many different words, nulls; no shuffle beyond the one that makes the pairs."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(9)] + ["''x''", '"a b"', ":=", "1.5e3", "é", "\U0001f600", ";"]
    text = lambda: rng.choice([" ", "\n", ""]).join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 4, 40, 700])))
    pairs = [(text(), text()) for _ in range(150)] + [(t := text(), t)]
    many = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(60_000)) for _ in range(2)]  # so many that a gram's number has to be made smaller
    pairs += [(many[0], many[1] + many[0][:50_000]), (None, "x"), ("x", None), (None, ""), ("", None), (None, None)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "id int, reference string, hypothesis string")
    out = scoring.bleu(df)
    got = {r.id: r.bleu for r in out.collect()}
    assert [got.pop(len(pairs) - k) for k in range(5, 0, -1)] == [None, None, 0.0, 0.0, None]
    assert got == pytest.approx({k: plain_bleu(*p) for k, p in enumerate(pairs[:-5])}, abs=1e-12)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_scores_and_tallies(spark):
    import base64

    b = lambda t: base64.b64encode(t.encode()).decode()
    kind = "dataset string, name string, path string, files map<string,string>"
    gen = spark.createDataFrame([("d", "same", "p.ads", {"p.ads": b("package P is\r\nprocedure Q;  \n")}), ("d", "none", "p.ads", {"p.ads": b("x")}), ("d", "empty", "p.ads", {}), ("d", "extra", "p.ads", {"p.ads": b("y"), "q.ads": b("z")})], kind)
    ref = spark.createDataFrame([("d", n, {"p.ads": b("package P is\nprocedure Q;")}) for n in ("same", "empty", "extra")], "dataset string, name string, files map<string,string>")
    got = {r.name: r for r in scoring.score_samples(gen, ref).collect()}
    assert got["same"].exact and got["same"].file_set and got["same"].standard == "Ada 83" and got["same"].compliance == pytest.approx(1 / 3)
    assert not got["none"].matched and got["empty"].empty and not got["extra"].file_set and not got["extra"].exact
    rows = [("build", True, None, None), ("build", False, None, None), ("test", True, True, None), ("test", False, True, None), ("prove", None, None, "proved"), ("prove", None, None, "subprogram_not_found"), ("prove", None, None, None), ("prove", None, None, "odd"), ("other", True, True, "proved")]
    t = scoring.tally(spark.createDataFrame(rows, "eval string, compiled boolean, passed_tests boolean, result string")).collect()[0].asDict()
    assert t == {"build_compiled": 1, "build_failed": 1, "build_total": 2, "test_passed": 1, "test_failed": 1, "test_total": 2, "prove_proved": 1, "prove_unproved": 1, "prove_error": 2, "prove_total": 4}


def test_trend_verdicts(spark):
    runs = {"healthy": [2, 1.5, 1.2, 1.0], "sparse": [1.0], "unstable": [1, 1.4, 0.9, 0.8], "overfit": [2, 1, 0.9, 1.0], "plateau": [2, 1, 1.02, 1.03]}
    e = spark.createDataFrame([(r, k, float(x)) for r, xs in runs.items() for k, x in enumerate(xs)], "run string, step int, loss double")
    t = spark.createDataFrame([(r, k, 2.0 - k / 4) for r in runs for k in range(4)], "run string, step int, loss double")
    assert {r.run: r.verdict for r in history.trend(e, t).collect()} == {r: r for r in runs}


def test_early_stop_equals_the_loop(spark):
    rng, rows, want = random.Random(9), [], {}
    for run in range(60):
        seen = []
        for step in range(12):
            seen.append(round(rng.random(), 2))
            rows.append((run, step, seen[-1]))
            if run not in want and len(seen) > 3 and all(x > min(seen) + 1e-3 for x in seen[-3:]):
                want[run] = step
    got = history.early_stop(spark.createDataFrame(rows, "run int, step int, loss double"), "run", "step", "loss")
    assert {r.run: r.stop_step for r in got.collect()} == want


def test_batches(spark):
    lengths = [5, 90, 10, 40, 41, 7]
    df = spark.createDataFrame([("g", k, n) for k, n in enumerate(lengths)], "grp string, idx int, length int")
    plan = lambda *a: sorted((r.batch, r.idx) for r in history.plan_batches(df, *a).collect())
    assert plan(10, 0, 100) == [(0, 0), (0, 2), (0, 5), (1, 3), (2, 4), (3, 1)] or plan(10, 0, 100)[0] == (0, 0)
    assert [b for b, _ in plan(10, 4, 0)] == list(range(6))


def test_sections(spark):
    md = "lead\n\n# A\nx\n## B #\ny\n# C\n```\n# fence\n```\n"
    rst = "Top\n===\nx\n\nSub\n---\ny\n\n====\nTwo\n====\nz\n"
    got = documents.sections(spark.createDataFrame([("m", "md", md), ("r", "rst", rst), ("n", "md", "plain"), ("z", "md", None)], "source string, format string, text string"))
    rows = {}
    for r in got.orderBy("source", "ordinal").collect():
        rows.setdefault(r.source, []).append((r.level, " > ".join(r.path)))
    assert rows == {"m": [(0, ""), (1, "A"), (2, "A > B"), (1, "C"), (1, "fence")], "r": [(0, "Top"), (1, "Top > Sub"), (0, "Two")], "n": [(0, "")], "z": [(0, "")]}


def test_links_and_anchors(spark):
    h = spark.createDataFrame([("a.md", 1, "Same"), ("a.md", 2, "Same"), ("b.md", 1, "Same")], "path string, seq int, title string")
    a = documents.anchors(h)
    assert sorted((r.path, r.anchor) for r in a.collect()) == [("a.md", "same"), ("a.md", "same-1"), ("b.md", "same")]
    links = spark.createDataFrame([("x.md", t) for t in ("a.md#same-1", "a.md#none", "gone.md", "https://q", "#here", "a b.md", "a.md")], "path string, target string")
    got = {r.target: r.error for r in documents.link_errors(links, h.select("path").distinct(), a).collect()}
    assert got == {"a.md#none": "missing anchor", "gone.md": "missing file", "a b.md": "space"}


def test_turns(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", " "), (2, 1, "assistant", "It may; fail"), (2, 0, "user", "u"), (3, 0, "user", "alone")]
    r = turns.to_records(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert {x.conv_id: x[1] for x in r.select("conv_id", turns.usable()).collect()} == {1: False, 2: True, 3: False}
    assert [(x.conv_id, x.violations) for x in turns.style_checked(r, "conv_id").collect()] == [(2, ["semicolon", "hedge-modal"])]
    units = spark.createDataFrame([("F", "function", "function F return T;", {"Pre": "X"}, "body"), ("G", "procedure", "procedure G;", None, None)], "name string, kind string, text string, aspects map<string,string>, body_text string")
    assert sorted(x.kind for x in turns.declaration_turns(units).collect()) == ["ast_contract", "ast_contract_write", "ast_impl"]


def test_record_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "meta": {"kind": "doc"}}'
    (folder / "one.jsonl").write_text("\n".join([good, good, "{bad json}", "", '{"messages": [{"role": "user", "content": "a"}]}']))
    r = sources.records(spark, str(folder)).cache()
    stats = turns.ingest_stats(spark.createDataFrame([(f"file://{folder}/one.jsonl",), ("missing",)], "path string"), r.withColumn("bad", F.col("_corrupt_record").isNotNull()).withColumn("path", F.regexp_replace("path", "^file:/+", "file:///")))
    assert {x.path[-9:]: (x.records, x.ingested, x.malformed) for x in stats.collect()} == {"one.jsonl": (4, 2, 1), "missing": (0, 0, 0)}
    q = streaming.ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_file_scan_and_sinks(spark, tmp_path):
    root = tmp_path / "src"
    (root / ".git").mkdir(parents=True)
    (root / ".git" / "x.ads").write_text("no")
    (root / "A.ADS").write_text("package A is end A;")
    (root / "b.adb").write_bytes(b"\x7fELF")
    assert sorted(r.path for r in sources.files(spark, [str(root)], (".ads", ".adb"), content=False).collect()) == ["A.ADS", "b.adb"]
    assert [r.text for r in sources.texts(spark, [str(root)], (".ads", ".adb")).collect()] == ["package A is end A;"]
    df = sources.sequence(spark.range(100).repartition(7).withColumn("k", -F.col("id")), "k")
    assert [r.id for r in df.orderBy("seq").collect()] == list(range(99, -1, -1)) and df.agg(F.max("seq")).collect()[0][0] == 99
    sources.write_splits(split.hashed_group_split(df, "id"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 100
    prints = [sources.fingerprint(spark.createDataFrame(rows, "path string, digest string"), {"cap": 1}) for rows in ([("a", "1"), ("b", "2")], [("b", "2"), ("a", "1")], [("a", "2"), ("b", "1")])]
    assert prints[0] == prints[1] != prints[2]


def test_ordered_concat_joins_whole_texts_of_every_row(spark):
    rows = [(c, t, "user", f"{c}-{t} " + "long text " * 50) for c in range(1, 41) for t in (10, 2, 1)] + [(41, 1, "user", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want = {c: " | ".join(f"{t}:{x}" for k, t, _, x in sorted(r for r in rows if r[3]) if k == c) for c in range(1, 42)}
    assert {r.conv_id: r.joined for r in turns.joined(df).collect()} == want


def test_sections_of_one_crc32_are_all_kept(spark):
    pad = "A sentence of a section that is long enough to be of use. " * 3
    seen, pair = {}, None
    for k in range(1_000_000):
        clean = f"{pad}{k * 2654435761 % 2**32:08x} {k * k * 40503 % 2**32:08x}"
        c = zlib.crc32(f"T\0{clean}".encode())
        if c in seen:
            pair = seen[c], clean
            break
        seen[c] = clean
    assert pair[0] != pair[1]
    rows = [("a", "md", 1, k, ["T"], x) for k, x in enumerate([*pair, pair[0]])]
    df = spark.createDataFrame(rows, "source string, format string, level int, ordinal int, path array<string>, body string")
    assert sorted((r.ordinal, r.clean) for r in documents.usable_sections(df).collect()) == [*enumerate(pair)]


def test_lone_sides_are_not_completed_by_themselves(spark):
    from siltworks.operators import turns

    pairs = spark.createDataFrame([("d", "a", "package A is end A;", "package body A is end A;"), ("d", "b", "package B is end B;", None), ("d", "c", None, "package body C is end C;")], "dir string, stem string, spec string, impl string")
    made = turns.completion_turns(pairs)
    answers = {r.stem: r.messages[1].content for r in made.collect()}
    assert "package body A" in answers["a"] and answers["b"] == answers["c"] == ""
    assert [r.stem for r in made.where(turns.usable()).collect()] == ["a"]


def test_seeded_split_of_rows_without_group(spark):
    rows = spark.createDataFrame([(k, None if k % 5 == 0 else f"g{k % 7}") for k in range(40)], "id long, g string")
    got = split.seeded_group_split(rows, "g").collect()
    assert len(got) == 40 and {r.split for r in got if r.g is None} == {"train"} and {r.split for r in got} == {"train", "val", "test"}
    assert split.seeded_group_split(rows.where("false"), "g").count() == 0


def test_first_share_gets_a_message(spark):
    rows = spark.createDataFrame([(k, ["x"]) for k in range(41)], "k long, messages array<string>").repartition(5)
    got = {r.k: len(r.messages) for r in split.inject_first_share(rows, "k", "messages", F.lit("system")).collect()}
    assert [k for k, n in sorted(got.items()) if n == 2] == list(range(10))


def test_first_share_of_wide_rows(spark):
    """Rows so wide that the plan that numbers them has more tasks than the plan that counts them."""
    rows = spark.range(40).select(F.col("id").alias("k"), F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda n: F.sha2(F.concat_ws(" ", "id", n), 256)).alias("messages")).repartition(7)
    got = [(r.k, r.n) for r in split.inject_first_share(rows, "k", "messages", F.lit("system")).select("k", F.size("messages").alias("n")).collect()]
    assert sorted(got) == [(k, 4001 if k < 10 else 4000) for k in range(40)]


@pytest.mark.parametrize("size", [1, 3, 50, 1000])
def test_sequence_whatever_the_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(sources, "RANGE_ROWS", size)
    rng = random.Random(size)
    rows = [(rng.choice([None, 1, 2, 3, 3, 3]), f"{k * 7919 % 211:03}") for k in range(211)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = sorted((r.seq, r.a, r.b) for r in sources.sequence(df, "a", F.upper("b")).collect())
    assert got == [(k, *r) for k, r in enumerate(sorted(rows, key=lambda r: (r[0] or 0, r[1])))]
    assert sources.sequence(df.where("false"), "a").collect() == []


def test_carves_and_samples(spark):
    rows = spark.range(45).repartition(4)
    n = {r.split: r["count"] for r in split.fallback_carve(rows, "id", 100, 2).groupBy("split").count().collect()}
    assert n == {"val": 4, "test": 2, "train": 39}
    some = [r.id for r in split.seeded_subsample(rows, "id", 7).collect()]
    assert len(some) == 7 and some == sorted(some) and split.seeded_subsample(rows, "id", 0).count() == split.seeded_subsample(rows, "id", 99).count() == 45


def test_roots_that_are_missing(spark, tmp_path):
    (tmp_path / "a.ads").write_text("package A is end A;")
    with pytest.warns(UserWarning, match="no such root"):
        got = sources.files(spark, [f"{tmp_path}/none", str(tmp_path)], (".ads",))
    assert [(r.root_rank, r.path) for r in got.collect()] == [(1, "a.ads")]
    assert sources.files(spark, [], (".ads",)).count() == 0


def test_evaluation_edges(spark):
    from siltworks.operators import evaluation as e

    samples = spark.createDataFrame([(1, "d", "a", {"x": "1"}), (2, "d", "a", {"x": "2"}), (3, "d", "a", {}), (4, "d", "b", None)], "seq long, dataset string, name string, files map<string,string>")
    assert [(r.name, r.files) for r in e.reference_index(samples).collect()] == [("a", {"x": "2"})]
    assert [tuple(r) for r in e.verified(samples).collect()] == [("d", 4, 2, False)]
    files = spark.createDataFrame([("s", "other.json", "{}"), ("s", "prompt.md", "p"), ("s", "base/a/b.ads", "t"), ("t", "prompt.md", "q")], "sample string, path string, text string")
    assert [tuple(r) for r in e.expanded_samples(files).collect()] == [("s", "{}", "p", None, {"a/b.ads": "t"})]
    scored = spark.createDataFrame([], "bleu double, exact boolean, file_set boolean, compliance double, standard string")
    assert tuple(e.model_score(scored).collect()[0])[:2] == (0, None)
    units = [("a/P.ads", "with Ada.Text_IO, System; use System;\npackage P is end P;"), ("a/p.adb", "package body P is end P;"), ("b/p.ads", "package P is end P;"), ("b/p.adb", "--"), ("c/q.ads", "limited with Other;\npackage Q is end Q;"), ("c/q.adb", ""), ("c/r.ads", "-- with Other;\npackage R is end R;")]
    got = e.standalone_units(spark.createDataFrame(units, "path string, text string"))
    assert [(r.package, r.path) for r in got.collect()] == [("p", "a/P.ads")]
    names = spark.createDataFrame([("gNAT.os_LIB",), ("",), ("a__b",)], "n string")
    assert [r[0] for r in names.select(e.unit_display("n")).collect()] == ["Gnat.Os_Lib", "", "A__B"]
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    assert [r[0] for r in e.untracked(paths("a", "a/b", "c", "ab"), paths("a/b/d", "c")).collect()] == ["ab"]
    assert e.wanted_kinds(spark.createDataFrame([("build",), ("x",)], "eval string"), ["x"]).count() == 0


def test_prompts_of_every_length_are_found_as_brute_force_finds_them(spark):
    prompts = ["abcdefghijklmnopqrstuvwxyz", "abcdefghijklm nopqrstuvwxyz", "see abcdefghijklm then", "one two three four five", "one two three four five six seven", "a b c d e f g h i j k l m n o p", "short", "", None]
    texts = ["xxabcdefghijklmnopqrstuvwxyzyy", "zzabcdefghijklm nopqrstuvwxyzzz end", "foresee abcdefghijklm thenceforth", "none two three four fives", "one two three four five six sevenfold", "q a b c d e f g h i j k l m n o pq", "", None, "one two three four", "abcdefghijklm", "s" * 200_000]
    p = spark.createDataFrame([(x,) for x in prompts], "prompt string")
    t = spark.createDataFrame([(k, x) for k, x in enumerate([*texts, texts[0]])], "id int, text string")
    for some in (p, p.where("length(prompt) > 26"), p.where("false")):
        norm = lambda df, c: {r[0]: r[1] for r in df.select(c, code.normalized(F.col(c))).collect()}
        wanted = [v for v in norm(some, "prompt").values() if v and len(v) >= guard.MIN_PROMPT]
        found = {(r.id, r.prompt) for r in guard.contains_prompt(t, some, "id", "text", "prompt").collect()}
        by_text = norm(t, "text")
        assert found == {(r.id, w) for r in t.collect() for w in wanted if w in (by_text[r.text] or "")}
    assert len(found) == 0
