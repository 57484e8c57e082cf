"""Joins of files, declarations, lab twins and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.operators.dedup import first_wins


def file_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """files with dir, stem and ext (lower case) of the path."""
    name = F.element_at(F.split(path, "/"), -1)
    return files.withColumns({"dir": F.regexp_extract(F.col(path), r"^(.*)/[^/]*$", 1), "stem": F.regexp_replace(name, r"\.[^.]*$", ""), "ext": F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))})


def pair_files(files: DataFrame, path: str = "path") -> DataFrame:
    """(dir, stem, spec, impl): full outer pairs of .ads and .adb files; of several specs of a body the first path is paired, the others stand alone."""
    parts = file_parts(files, path)
    specs, bodies = (parts.where(F.col("ext") == e).select("dir", "stem", F.col(path).alias(n)) for e, n in ((".ads", "spec"), (".adb", "impl")))
    first = first_wins(specs, ["dir", "stem"], ["spec"])
    pairs = first.join(first_wins(bodies, ["dir", "stem"], ["impl"]), ["dir", "stem"], "full")
    others = specs.join(first.select("spec"), "spec", "left_anti").select("dir", "stem", "spec", F.lit(None).cast("string").alias("impl"))
    return pairs.unionByName(others)


def declaration_bodies(decls: DataFrame, bodies: DataFrame) -> DataFrame:
    """Declarations with the first body of the same package, kind and name, case-blind: N:1, null without one."""
    key = ["k_package", "k_kind", "k_name"]
    keyed = lambda df: df.withColumns({k: F.lower(k[2:]) for k in key})
    first = first_wins(keyed(bodies), key, ["seq"]).select(*key, F.col("text").alias("body_text"))
    return keyed(decls).join(first, key, "left").drop(*key)


def lab_twins(files: DataFrame) -> DataFrame:
    """Prompt and answer files of the same root, lab and relative path whose stripped texts differ."""
    sides = [files.where(F.col("side") == s).select("root", "lab", "rel", F.col("text").alias(s)) for s in ("prompt", "answer")]
    both = sides[0].join(sides[1], ["root", "lab", "rel"])
    return both.where(F.trim("prompt") != F.trim("answer"))


def cache_status(cached: DataFrame, upstream: DataFrame) -> DataFrame:
    """(source, status): absent, untracked, unknown, current or moved."""
    both = cached.join(upstream, "source", "left")
    status = F.when(F.col("present") == F.lit(False), "absent").when(F.col("commit").isNull(), "untracked").when(F.col("head").isNull(), "unknown").when(F.col("commit") == F.col("head"), "current").otherwise("moved")
    return both.select("source", status.alias("status"))


def with_default_flag(units: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """units with the flag of their key; absent means false."""
    return units.join(flags, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
