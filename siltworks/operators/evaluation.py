"""Benchmark samples, generated solutions and results: scans, filters, joins and means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Results of a sample that can be asked for.
KINDS = ("build", "test", "prove")


def short_name(dataset: str | Column) -> Column:
    """A dataset's name without one leading `spark_`, so that `learn` and `spark_learn` are one."""
    return F.regexp_replace(dataset, "^spark_", "")


def wanted_datasets(df: DataFrame, wanted: list[str], column: str = "dataset") -> DataFrame:
    """Rows of the wanted datasets, with or without the prefix on either side; all rows if none is named."""
    return df.where(short_name(column).isin([w.removeprefix("spark_") for w in wanted])) if wanted else df


def wanted_kinds(df: DataFrame, wanted: list[str], column: str = "eval") -> DataFrame:
    """Rows of the wanted kinds that exist; all rows if none is named."""
    return df.where(F.col(column).isin([k for k in KINDS if k in wanted])) if wanted else df


def has_solution(files: str | Column) -> Column:
    """A sample that isn't hollow: it has a solution file."""
    return F.coalesce(F.size(files) > 0, F.lit(False))


def reference_index(samples: DataFrame, order: str = "seq") -> DataFrame:
    """One row per (dataset, name): hollow samples are dropped, of the others the last wins."""
    keys = ["dataset", "name"]
    last = samples.where(has_solution("files")).groupBy(*keys).agg(F.max_by(F.struct(*[c for c in samples.columns if c not in keys]), order).alias("s"))
    return last.select(*keys, "s.*")


def verified(samples: DataFrame) -> DataFrame:
    """(dataset, samples, hollow, ok) of packed samples: a dataset is in order if it has samples and none is hollow."""
    hollow = F.count_if(~has_solution("files"))
    return samples.groupBy("dataset").agg(F.count("*").alias("samples"), hollow.alias("hollow"), (hollow == 0).alias("ok"))


def expanded_samples(files: DataFrame) -> DataFrame:
    """(sample, other, prompt, comments, base) from files(sample, path, text): `other.json` and `prompt.md` must be there, `comments.md` may be; base is the map of the files below `base/`."""
    at = lambda name: F.max(F.when(F.col("path") == name, F.col("text")))
    below = F.collect_list(F.when(F.startswith("path", F.lit("base/")), F.struct(F.substring("path", 6, 1 << 20).alias("key"), F.col("text").alias("value"))))
    out = files.groupBy("sample").agg(at("other.json").alias("other"), at("prompt.md").alias("prompt"), at("comments.md").alias("comments"), F.map_from_entries(F.array_sort(below)).alias("base"))
    return out.where("other IS NOT NULL AND prompt IS NOT NULL")


def reply_summary(scored: DataFrame, meta: DataFrame) -> DataFrame:
    """(known, by_format, unchanged) of scored(name) joined with what is known of the replies, meta(name, reply_format, changed_files); names without it don't count as known."""
    both = scored.join(meta, "name", "left").where("reply_format IS NOT NULL")
    shapes = both.groupBy("reply_format").agg(F.count("*").alias("n"), F.count_if(F.col("changed_files") == 0).alias("none"))
    entry = F.struct(F.col("reply_format").alias("key"), F.col("n").alias("value"))
    return shapes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("known"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("by_format"), F.coalesce(F.sum("none"), F.lit(0)).alias("unchanged"))


def model_score(scored: DataFrame, *by: str) -> DataFrame:
    """Means of scored(bleu, exact, file_set, compliance) and the number of samples per standard; nothing scored gives nulls."""
    mean = lambda c: F.avg(F.col(c).cast("double")).alias(c)
    means = scored.groupBy(*by).agg(F.count("*").alias("scored"), mean("bleu"), mean("exact"), mean("file_set"), mean("compliance"))
    each = F.struct(F.col("standard").alias("key"), F.col("n").alias("value"))
    counts = scored.groupBy(*by, "standard").agg(F.count("*").alias("n")).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(each))).alias("standards"))
    return means.join(counts, list(by)) if by else means.crossJoin(counts)  # one row each


def family_tally(results: DataFrame) -> DataFrame:
    """(family, passed, failed, skipped) over all sources of results(family, outcome)."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return results.groupBy("family").agg(n("pass").alias("passed"), n("fail").alias("failed"), n("skip").alias("skipped"))


def check_histogram(results: DataFrame, checks: str = "unproved_checks", top: int | None = 8) -> DataFrame:
    """(check, n) summed over a map of counts, most first (ties by name); the top 8, or all."""
    each = results.select(F.explode(checks).alias("check", "k")).groupBy("check").agg(F.sum("k").alias("n")).orderBy(F.desc("n"), "check")
    return each.limit(top) if top else each


# Roots of library units that need no other project.
STANDALONE = ("ada", "system", "interfaces", "gnat")


def standalone(spec: str | Column) -> Column:
    """Every unit that a text's context clauses name has one of those roots."""
    lists = F.regexp_extract_all(F.regexp_replace(spec, r"--[^\n]*", ""), F.lit(r"(?im)^\s*(?:limited\s+|private\s+)*with\s+([\w.,\s]+);"), F.lit(1))
    names = F.flatten(F.transform(lists, lambda x: F.split(F.lower(F.trim(x)), r"\s*,\s*")))
    return F.forall(names, lambda n: F.element_at(F.split(n, r"\."), 1).isin(*STANDALONE))


def standalone_units(files: DataFrame, limit: int = 0) -> DataFrame:
    """(package, path, spec, body) of files(path, text): specs with a body of the same folder and stem, both standalone; the first path of a package stays, and the first `limit` of them (0: all)."""
    stem = F.regexp_replace(F.lower("path"), r"\.ad[sb]$", "")
    rows = files.withColumn("stem", stem).withColumn("ext", F.lower(F.substring_index("path", ".", -1)))
    spec = rows.where("ext = 'ads'").select("stem", "path", F.col("text").alias("spec"))
    both = spec.join(rows.where("ext = 'adb'").select("stem", F.col("text").alias("body")), "stem").where(standalone("spec") & standalone("body"))
    named = both.withColumn("package", F.lower(F.regexp_extract("spec", r"(?im)^\s*package\s+([\w.]+)", 1))).where("package <> ''")
    first = named.groupBy("package").agg(F.min_by(F.struct("path", "spec", "body"), "path").alias("u")).select("package", "u.*")
    return first.orderBy("path").limit(limit) if limit > 0 else first


def unit_display(name: str | Column) -> Column:
    """A unit's name as the compiler shows it: a capital at the start and after each `_` or `.`, else lower case."""
    parts = F.regexp_extract_all(F.lower(name), F.lit("[^_.]*[_.]?"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))), "")


def variant_sources(records: DataFrame, kind: str | Column = "kind") -> DataFrame:
    """Records that variants may be made of: not fixes or defects themselves."""
    return records.where(~F.coalesce(F.col(kind), F.lit("")).rlike("_(fix|defect)$"))


def first_usable(files: DataFrame, group: str, order: str, usable: Column, among: int = 3) -> DataFrame:
    """Per group the first usable row among its first few, in order."""
    w = Window.partitionBy(group).orderBy(order)
    near = files.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= among).where(usable)
    cols = [c for c in files.columns if c != group]
    return near.groupBy(group).agg(F.min_by(F.struct(*cols), "nth").alias("f")).select(group, "f.*")


def by_priority(df: DataFrame, key: str, priorities: list[str], *then: str) -> DataFrame:
    """df in the order of a list of keys (others last), then of further columns; `rank` tells the place in the list."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[x for k, p in enumerate(priorities) for x in (F.lit(p), F.lit(k))]), F.col(key)), F.lit(len(priorities)))
    return df.withColumn("rank", rank).orderBy("rank", *then)


def ordered_union(*parts: DataFrame, key: str) -> DataFrame:
    """(key, part): every key once, with the first part that has it."""
    tagged = [p.select(F.col(key), F.lit(k).alias("part")) for k, p in enumerate(parts)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out.groupBy(key).agg(F.min("part").alias("part"))


def bag_union(parts: dict[str, DataFrame], order: str) -> DataFrame:
    """All rows of all parts with their kind and its rank; (kind_rank, order) is the order of the corpus. Columns that a part lacks are null."""
    out = None
    for rank, (kind, df) in enumerate(parts.items()):
        own = df.withColumns({"kind": F.lit(kind), "kind_rank": F.lit(rank)})
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def untracked(ignored: DataFrame, tracked: DataFrame, path: str = "path") -> DataFrame:
    """Ignored paths that are not tracked, as a file or as a folder above a tracked one. Folders above tracked paths are rows, so no path is compared with all others."""
    parts = F.split(path, "/")
    above = tracked.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias(path)).distinct()
    return ignored.select(path).distinct().join(above, path, "left_anti")


