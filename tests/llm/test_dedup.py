"""Exact and near duplicates and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import exactdup, neardup, substrdup

SCHEMA = "doc_id long, text string, sha string, rep long, key string"


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(3)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def mutated(rng, text, share):
    return [f"m{rng.randrange(10**6)}" if rng.random() < share else w for w in text]


def test_exact_groups_nulls_ties_and_order(spark):
    rows = [(1, "a"), (5, "a"), (3, "a"), (2, None), (7, ""), (4, "A"), (9, "b"), (9, "b"), (None, "a"), (None, "c")]
    got = exactdup.exact_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    for text, keep, size in (("a", 5, 4), ("", 7, 2), ("A", 4, 1), ("b", 9, 2), ("c", None, 1)):
        group = by[hashlib.sha256(text.encode()).hexdigest()]
        assert {r.keep_id for r in group} == {keep} and {r.group_size for r in group} == {size} and len(group) == size
        assert sum(r.kept for r in group) == 1


def test_exact_hot_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(exactdup, "HOT_ROWS", 5)
    monkeypatch.setattr(exactdup, "HOT_SHARE", 0.01)
    rows = [(k, "hot" if k % 3 else f"text {k % 7}") for k in range(90)]
    got = {r.doc_id: r for r in exactdup.exact_duplicates(docs(spark, rows).repartition(8)).collect()}
    for text in {t for _, t in rows}:
        same = [d for d, t in rows if t == text]
        assert all(got[d].keep_id == max(same) and got[d].group_size == len(same) for d in same)
    kept = exactdup.drop_exact_duplicates(docs(spark, rows + [(89, "hot")]))
    assert kept.columns == ["doc_id", "text", "sha", "rep", "key"] and kept.count() == len({t for _, t in rows})


@pytest.mark.parametrize("hot", [1_000, 4])
def test_exact_texts_that_share_a_digest_are_told_apart(spark, monkeypatch, hot):
    monkeypatch.setattr(exactdup, "_digest", lambda body: F.substring(F.sha2(body, 256), 1, 1))
    monkeypatch.setattr(exactdup, "HOT_ROWS", hot)
    rows = [(k, f"text {k % 37}") for k in range(120)] + [(5, "text 5"), (None, "text 1"), (200, None), (201, "")]
    got = exactdup.exact_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 38
    for r in got:
        if r.doc_id is not None:
            same = [d for d, t in rows if (t or "") == (dict(rows)[r.doc_id] or "")]
            assert r.keep_id == max(d for d in same if d is not None) and r.group_size == len(same) and (not r.kept or r.doc_id == r.keep_id)


def test_exact_keeps_columns_of_any_name_and_long_texts(spark):
    long = "word " * 2_000_000
    rows = spark.createDataFrame([(1, long, "a", 1), (2, long, "b", 2), (3, long + ".", "c", 3)], "doc_id long, text string, key string, sha long")
    kept = exactdup.drop_exact_duplicates(rows).select("doc_id", "key", "sha").collect()
    assert sorted(map(tuple, kept)) == [(2, "b", 2), (3, "c", 3)]


def test_exact_empty_table(spark):
    assert exactdup.exact_duplicates(docs(spark, [(1, "a")]).where("false")).count() == 0


def near_brute(rows, percent, shingle):
    sets = {}
    for d, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("percent", "shingle", "cell"), [(85, 3, 500), (80, 5, 500), (80, 5, 4)])
def test_near_components_equal_brute_force(spark, monkeypatch, percent, shingle, cell):
    monkeypatch.setattr(neardup, "CELL", cell)
    monkeypatch.setattr(neardup, "SALT_ROWS", cell)
    rng, rows = random.Random(percent), []
    for _ in range(12):  # families of copies with growing changes, linked or not, directly or by others
        base = words(rng, rng.choice([8, 30, 120]))
        rows += [" ".join(mutated(rng, base, rng.choice([0, 0.005, 0.02, 0.03, 0.06, 0.1]))) for _ in range(12)]
    rows += ["", None, " \t\n", "one", "ONE", "one two", "É é", "é É", "x y z w", rows[0], rows[1].upper()]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(spark, rows), percent, shingle).collect()}
    assert got == near_brute(rows, percent, shingle)


def test_near_hot_group_is_dealt_to_cells(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CELL", 10)
    rng = random.Random(9)
    base = words(rng, 60)
    rows = list(enumerate([" ".join(mutated(rng, base, rng.choice([0.01, 0.03, 0.05]))) for _ in range(150)] + [" ".join(words(rng, 30)) for _ in range(30)]))
    seen, settle = [], neardup._settle
    monkeypatch.setattr(neardup, "_settle", lambda cfg: seen.append(1) or settle(cfg))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(spark, rows), 80, 5).collect()}
    assert seen and got == near_brute(rows, 80, 5)


def test_cells_are_whole_whatever_the_batches():
    import pyarrow as pa

    table = pa.table({"a": [1, 1, 1, 2, 2, 3], "b": [0, 0, 1, 1, 1, 1], "x": [*range(6)]})
    for size in (1, 2, 4, 6):
        got = [t.column("x").to_pylist() for t in neardup._groups(iter(table.to_batches(max_chunksize=size)), 2)]
        assert got == [[0, 1], [2], [3, 4], [5]]


def test_keys_of_masked_chunks_are_wide():
    for percent, shingle in ((85, 3), (80, 5)):
        cfg = neardup.scheme(percent, shingle)
        edges = neardup.chunk_edges(cfg)
        assert cfg.chunks > cfg.distance // 2 and edges[-1] == cfg.symbols and (min(np.diff(edges)) - 1) * neardup.BITS >= 48


def test_near_edge_rows(spark):
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (2, "A b c d"), (9, "q r s")]
    got = neardup.near_duplicates(docs(spark, rows), 85, 3).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None) == [(2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert neardup.near_duplicates(docs(spark, rows).where("false"), 85, 3).count() == 0
    assert neardup.drop_near_duplicates(docs(spark, [(4, "a b c d e f"), (2, "a b c d e F")])).collect()[0].doc_id == 2


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    text = "alpha BETA\tgamma\n" * 50 + "x" * 300 + " tail"
    whole, counts = neardup.word_hashes([text, "", "alpha"])
    monkeypatch.setattr(neardup, "SEGMENT", 40)
    parts, again = neardup.word_hashes([text, "", "alpha"])
    assert (whole == parts).all() and (counts == again).all() and counts.tolist() == [152, 0, 1]


def passages_brute(rows):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            cover[k : k + 100] |= w in seen
            seen.add(w)
        left = bytes(np.frombuffer(b, np.uint8)[~cover]) if b else b""
        out[d] = (len(b), int(cover.sum()), int((np.diff(np.r_[0, cover.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 12, 3])
def test_passages_equal_brute_force(spark, hot):
    rng = random.Random(hot)
    passages = [" ".join(words(rng, 40)) for _ in range(4)]
    rows = [" ".join(words(rng, rng.randrange(60)) + [rng.choice(passages)[rng.randrange(40) :]] * rng.randrange(3) + words(rng, rng.randrange(60))) for _ in range(40)]
    rows += [rows[0], rows[3], None, "", "short", "short", "a" * 450, "ab" * 200, "é" * 130, "\xff\x00" * 80, passages[0][:100], passages[0][:99]]
    rows = [(3 * k, t) for k, t in enumerate(rows)]
    got = {r[0]: tuple(r)[1:] for r in substrdup.repeated_passages(docs(spark, rows), hot=hot).collect()}
    assert got == passages_brute(rows)


def test_passages_keep_bytes_and_odd_rows(spark):
    long = " ".join(words(random.Random(1), 60))
    rows = [(1, long), (2, "before " + long), (3, long), (None, long)]
    got = {r.doc_id: r for r in substrdup.repeated_passages(docs(spark, rows), keep_bytes=True).collect()}
    assert bytes(got[2].kept) == b"before " and bytes(got[3].kept) == b"" and bytes(got[1].kept).decode() == long and got[None].n_removed == 0
    assert substrdup.repeated_passages(docs(spark, rows).where("false")).count() == 0


def test_suffix_array_is_sorted():
    rng = random.Random(5)
    for letters in (b"ab", b"abc\n", bytes(range(256))):
        for _ in range(30):
            data = bytes(rng.choice(letters) for _ in range(rng.randrange(200)))
            order = substrdup.suffix_array(np.frombuffer(data, np.uint8), 300).tolist()
            assert order == sorted(range(len(data)), key=lambda k: data[k:])
            wanted = np.array([rng.random() < 0.3 for _ in data], bool)
            some = substrdup.suffix_array(np.frombuffer(data, np.uint8), 300, wanted).tolist()
            assert [k for k in some if wanted[k]] == [k for k in order if wanted[k]]
