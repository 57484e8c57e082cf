"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, exception phrases, length-normalised score."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stage, text_of

# Characters that are read as Latin letters, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ⅼ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
#: Signs between letters that are read over, and characters of no width.
SKIPPED = ["­", "​", "‌", "‍", "⁠", "﻿"]

#: A fit sees at most so many labelled texts of each label, those of the smallest hash of their id.
SAMPLE = 3_000
#: Terms of the lexicon, exception phrases, and candidates that the fit counts.
TERMS, EXCEPTIONS, CANDIDATES = 400, 400, 60_000
#: Length of character runs that may become terms.
GRAMS = (4, 5, 6, 7, 8)


def _fold_table() -> dict:
    return {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(c): None for c in SKIPPED}


def fold(text: str, table=None, _word=re.compile(r"[^\W_]+(?:[@$!|]+[^\W_]+)*|[@$!|]+[^\W\d_]+"), _odd=re.compile(r"[0-9@$!|]"), _sub=str.maketrans(SUBSTITUTES)) -> str:
    """Words in lower case between single blanks, homoglyphs and, in words that hold a letter, substitutes read as letters."""
    import unicodedata

    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(table or _fold_table())
    words = _word.findall(text)
    if _odd.search(text):
        words = [w.translate(_sub) if _odd.search(w) and any(c.isalpha() for c in w) else w for w in words]
    return f" {' '.join(words)} "


def _grams(word: str) -> set[str]:
    """Inner runs of a word, runs from its start (with a blank before), and the whole word between blanks."""
    marked = f" {word}"
    return {word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1)} | {marked[: n + 1] for n in GRAMS if n < len(word)} | {f" {word} "}


@dataclass(frozen=True)
class Lexicon:
    """Weighted terms, exception phrases and the logistic score's coefficients (constant, hits, hits by length)."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = ()
    coef: tuple[float, float, float] = (-3.0, 1.0, 1.0)


def matcher(lexicon: Lexicon):
    """A function from folded text to (weight of hits outside exceptions, words)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term, weight in lexicon.terms.items():
        automaton.add_word(term, (weight, len(term)))
    for phrase in lexicon.exceptions:
        automaton.add_word(phrase, (0.0, len(phrase)))
    if len(automaton):
        automaton.make_automaton()

    def hits(text: str) -> tuple[float, int]:
        words = text.count(" ") - 1 if text.strip() else 0
        found = [(end - size + 1, end, weight) for end, (weight, size) in automaton.iter(text)] if len(automaton) else []
        # exceptions by start, each with the furthest end of those up to it: the last one that starts before a hit tells whether any holds it
        masks = sorted((a, b) for a, b, w in found if not w)
        starts, ends = [a for a, _ in masks], [*accumulate((b for _, b in masks), max)]
        total, last = 0.0, -1
        for a, b, w in found:
            # overlapping terms count once; a hit inside an exception doesn't
            if w and a > last and not ((k := bisect_right(starts, a)) and ends[k - 1] >= b):
                total += w
                last = b - 1
        return total, words

    return hits


def features(weight: float, words: int) -> tuple[float, float, float]:
    """Constant, hits, and hits in proportion to the length (per square root of a hundred words)."""
    return 1.0, math.log1p(weight), weight / math.sqrt(1 + words / 100)


def score(coef, weight: float, words: int) -> float:
    z = sum(a * b for a, b in zip(coef, features(weight, words), strict=True))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def choose_terms(toxic: list[set[str]], clean: dict[str, int], n_clean: int) -> dict[str, float]:
    """Whole words of toxic texts that clean texts lack, then a greedy cover of the toxic texts by such runs, which also fit words not seen yet.

    A weight is the smoothed log odds of the shares of toxic and clean texts that hold the term.
    """
    where = defaultdict(set)
    for k, own in enumerate(toxic):
        for g in own:
            where[g].add(k)
    n = len(toxic)
    weight = lambda g: math.log((len(where[g]) + 0.5) / (n + 1)) - math.log((clean.get(g, 0) + 0.5) / (n_clean + 1))
    least = 2 if n < 200 else 3
    usable = {g: weight(g) for g in where if len(where[g]) >= least and weight(g) > 2.0}
    left, out = {g: len(where[g]) for g in usable}, {}
    covered = [0] * n
    words = sorted((g for g in usable if g[0] == g[-1] == " " and usable[g] > 3.5), key=lambda g: (-left[g], g))
    out.update((g, usable[g]) for g in words[: TERMS // 2])
    while left and len(out) < TERMS:
        # new texts covered, less what clean texts would hit; ties go to the surer, then the shorter run
        best = max(left, key=lambda g: (left[g] * min(usable[g], 6.0), usable[g], -len(g), g))
        if left[best] < least:
            break
        out[best] = usable[best]
        del left[best]
        for k in where[best]:
            covered[k] += 1
            if covered[k] == 3:  # each text is covered three times, as one term may be missing from a text like it
                for g in toxic[k]:
                    if g in left:
                        left[g] -= 1
    return out


def fit_score(rows: list[tuple[float, int, int]]) -> tuple[float, float, float]:
    """Logistic regression of the label on features(), by Newton steps with a small ridge."""
    import numpy as np

    x = np.array([features(w, n) for w, n, _ in rows])
    y = np.array([label for *_, label in rows], float)
    coef = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * coef)
        coef += step
        if abs(step).max() < 1e-6:
            break
    return tuple(map(float, coef))


def _count_grams(batches) -> Iterator:
    """Partial document counts of a partition: gram, toxic, clean."""
    table, counts = _fold_table(), (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            counts[label.as_py()].update({g for w in {*fold(text.as_py(), table).split()} for g in _grams(w)})
    yield from _counted(counts)


def _counted(counts) -> Iterator:
    import pyarrow as pa

    both = [*{**counts[0], **counts[1]}]
    for k in range(0, len(both), 100_000):
        part = both[k : k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[1][g] for g in part], pa.int64()), pa.array([counts[0][g] for g in part], pa.int64())], names=["gram", "toxic", "clean"])


def _count_words(terms: list[str]):
    """Partial document counts of the words that hold a term."""

    def run(batches) -> Iterator:
        table, counts, held = _fold_table(), (Counter(), Counter()), matcher(Lexicon(dict.fromkeys(terms, 1.0)))
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                counts[label.as_py()].update(w for x in {*fold(text.as_py(), table).split()} if held(w := f" {x} ")[0])
        yield from _counted(counts)

    return run


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most per_label labelled texts of each label, those of the smallest hash of their id.

    An id that is labelled more than once counts with its greatest label; null labels don't count.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__toxic"))
    part = lambda label: known.where(F.col("__toxic") == label).orderBy(F.xxhash64("__id"), "__id").limit(per_label)
    chosen = stage(part(0).union(part(1)), "toxic-ids")  # 2 * per_label rows at most
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "__id")
    return stage(texts.select("text", F.col("__toxic").alias("toxic")), "toxic-sample")


def fit(sample: DataFrame) -> Lexicon:
    """A lexicon with weights, exception phrases and score from sample(text, toxic).

    The sample is bounded, and so is what reaches the driver: CANDIDATES counts, the
    candidates of each toxic text, EXCEPTIONS words and two numbers a text. A sample without both
    labels gives an empty lexicon, which scores every text below 0.5.
    """
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Lexicon({})
    least = 2 if n[1] < 200 else 3
    sums = lambda df: df.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    grams = sums(sample.mapInArrow(_count_grams, "gram string, toxic long, clean long")).where((F.col("toxic") >= least) & (odds > 2))
    grams = [(r[0], r[2]) for r in grams.orderBy((F.col("toxic") * F.least(odds, F.lit(6.0))).desc(), "gram").limit(CANDIDATES).collect()]
    index = {g: k for k, (g, _) in enumerate(grams)}

    def own(batches) -> Iterator:
        import pyarrow as pa

        table = _fold_table()
        for batch in batches:
            found = [sorted({index[g] for w in {*fold(t, table).split()} for g in _grams(w) if g in index}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["own"])

    toxic = [{grams[k][0] for k in r[0]} for r in sample.where("toxic = 1").select("text").mapInArrow(own, "own array<int>").collect()]
    terms = choose_terms(toxic, dict(grams), n[0])
    words = sums(sample.mapInArrow(_count_words(list(terms)), "gram string, toxic long, clean long"))
    mostly_clean = words.where((F.col("clean") >= 2) & (F.col("clean") / n[0] > 2 * F.col("toxic") / n[1])).orderBy(F.desc("clean"), "gram").limit(EXCEPTIONS)
    lexicon = Lexicon(terms, tuple(r[0] for r in mostly_clean.collect() if r[0] not in terms))
    hits = sample.mapInArrow(_scored(lexicon, hits_only=True), "weight double, words long, toxic int").collect()
    return Lexicon(terms, lexicon.exceptions, fit_score([tuple(r) for r in hits]))


def _scored(lexicon: Lexicon, hits_only: bool = False):
    def run(batches) -> Iterator:
        import pyarrow as pa

        table, hits = _fold_table(), matcher(lexicon)
        for batch in batches:
            if hits_only:
                found = [hits(fold(t.as_py(), table)) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64()), batch.column(1)], names=["weight", "words", "toxic"])
            else:
                found = [hits(fold(t.as_py(), table)) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([score(lexicon.coef, *x) for x in found], pa.float64())], names=["doc_id", "score"])

    return run


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, in one pass without a shuffle.

    Null and empty texts have no hit and get the score of none; repeated rows are scored each; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_scored(lexicon), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs whose score is below the threshold; columns and texts unchanged."""
    return docs.where(_score_udf(lexicon)(text_of(text_col)) < threshold)


def _score_udf(lexicon: Lexicon):
    import pandas as pd

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, hits = _fold_table(), matcher(lexicon)
        for texts in batches:
            yield pd.Series([score(lexicon.coef, *hits(fold(t, table))) for t in texts], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")
