"""Scores of generated against reference code, and tallies of build, test and proof results."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import code

# Results that mean not proved, rather than that the prover broke.
UNPROVED = ("unproved", "proved_incorrectly", "subprogram_not_found")
# Blanks and digits are those of ASCII, as in Spark's and the SQL's expressions.
_SCORE_TOKEN = re.compile(code.SCORE_TOKEN, re.ASCII)


def bleu(pairs: DataFrame, id_col: str = "id", reference: str = "reference", hypothesis: str = "hypothesis", max_n: int = 4) -> DataFrame:
    """(id, bleu): clipped n-gram precisions of 1 to 4 with add-one on both sides, geometric mean, brevity penalty; 0 if a side is empty.

    A pair is scored where it lies, in time and memory linear in its texts: grams as rows would be a multiple of the texts to shuffle.
    Null if a side is null and the other isn't empty.
    """
    rows = pairs.select(id_col, reference, hypothesis)
    return rows.mapInArrow(_scored(max_n), T.StructType([rows.schema[id_col], T.StructField("bleu", T.DoubleType())]))


def _scored(max_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            scores = [_bleu(r.as_py(), h.as_py(), max_n) for r, h in zip(rows.column(1), rows.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], [rows.schema.names[0], "bleu"])

    return run


def _bleu(reference: str | None, hypothesis: str | None, max_n: int) -> float | None:
    r, h = (None if t is None else _SCORE_TOKEN.findall(t) for t in (reference, hypothesis))
    if r == [] or h == []:
        return 0.0
    if r is None or h is None:
        return None
    ids = defaultdict(count().__next__)
    r, h = (np.fromiter(map(ids.__getitem__, w), np.int64, len(w)) for w in (r, h))
    logs, of_r, of_h, most = 0.0, r, h, len(ids)
    for n in range(1, max_n + 1):
        if n > 1:  # a gram's number: that of its first n - 1 words, then its last word
            if most * len(ids) >= 1 << 62:
                numbers = np.unique(np.concatenate((of_r, of_h)), return_inverse=True)[1]
                of_r, of_h, most = numbers[: len(of_r)], numbers[len(of_r) :], len(numbers)
            of_r, of_h, most = of_r[:-1] * len(ids) + r[n - 1 :], of_h[:-1] * len(ids) + h[n - 1 :], most * len(ids)
        logs += math.log((_common(of_r, of_h) + 1) / (len(of_h) + 1)) if len(of_h) else math.log(1e-9)
    return (1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h))) * math.exp(logs / max_n)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two multisets of numbers."""
    both = np.sort(np.concatenate((a * 2, b * 2 + 1)))
    starts = np.flatnonzero(np.diff(both >> 1, prepend=-1))
    in_b = np.add.reduceat(both & 1, starts)
    return int(np.minimum(in_b, np.diff(starts, append=len(both)) - in_b).sum())


def decode_files(files):
    """Base64 file map to text."""
    return F.transform_values(files, lambda _, v: F.decode(F.unbase64(v), "UTF-8"))


def score_samples(generated: DataFrame, references: DataFrame) -> DataFrame:
    """Per generated sample: matched, empty, standard, exact, file_set, compliance, and both primary texts.

    generated(dataset, name, path, files) and references(dataset, name, files) with base64 file maps. Unmatched and empty
    samples stay as rows, to be counted apart.
    """
    r = references.select("dataset", "name", F.col("files").alias("ref"))
    both = generated.join(r, ["dataset", "name"], "left").withColumn("gen_files", decode_files(F.col("files"))).withColumn("ref_files", decode_files(F.col("ref")))
    text = lambda c: code.normalise_lines(F.coalesce(F.element_at(c, F.col("path")), F.lit("")))
    both = both.withColumns({"gen": text(F.col("gen_files")), "reference": text(F.col("ref_files"))})
    both = both.withColumn("standard", F.when(F.col("reference") == "", "Unknown").otherwise(code.standard(F.col("reference"))))
    matched, empty = F.col("ref").isNotNull(), F.size("gen_files") == 0
    names = lambda c: F.array_sort(F.map_keys(c))
    return both.select("dataset", "name", matched.alias("matched"), empty.alias("empty"), "standard", ((F.col("reference") != "") & (F.col("gen") == F.col("reference"))).alias("exact"), (names("gen_files") == names("ref_files")).alias("file_set"), code.compliance(F.col("gen"), F.col("standard")).alias("compliance"), "reference", "gen")


def tally(entries: DataFrame) -> DataFrame:
    """One row of counts from entries(eval, compiled, passed_tests, result); a test passes only if compiled too, and a missing result is an error."""
    kind, sure = F.col("eval"), lambda c: F.coalesce(c, F.lit(False))
    n = lambda c, name: F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).alias(name)
    compiled, passed = sure(F.col("compiled")), sure(F.col("compiled") & F.col("passed_tests"))
    proved, unproved = sure(F.col("result") == "proved"), sure(F.col("result").isin(*UNPROVED))
    b, t, p = kind == "build", kind == "test", kind == "prove"
    return entries.agg(
        n(b & compiled, "build_compiled"), n(b & ~compiled, "build_failed"), n(b, "build_total"), n(t & passed, "test_passed"), n(t & ~passed, "test_failed"), n(t, "test_total"),
        n(p & proved, "prove_proved"), n(p & unproved, "prove_unproved"), n(p & ~proved & ~unproved, "prove_error"), n(p, "prove_total"),
    )


def report(entries: DataFrame) -> DataFrame:
    """Per model, and per model and dataset (grouping sets): samples, builds, tests by passed_tests alone, proofs, and percentages."""
    sums = entries.sparkSession.sql(
        """SELECT model, dataset, CAST(grouping(dataset) AS INT) AS whole, count_if(eval = 'build') AS samples, count_if(eval = 'build' AND compiled) AS build,
                  count_if(eval = 'test' AND passed_tests) AS test, count_if(eval = 'prove' AND result = 'proved') AS proved,
                  count_if(eval = 'prove' AND result IN ('unproved', 'proved_incorrectly', 'subprogram_not_found')) AS unproved
           FROM {entries} GROUP BY GROUPING SETS ((model), (model, dataset))""",
        entries=entries,
    )
    return sums.withColumns({"build_pct": code.percent(F.col("build"), F.col("samples")), "test_pct": code.percent(F.col("test"), F.col("samples"))})


def all_proved(checks: DataFrame, unit: str = "unit", ok: str = "proved") -> DataFrame:
    """(unit, proved): true if every check is; units without checks have no row."""
    return checks.groupBy(unit).agg(F.every(ok).alias("proved"))
