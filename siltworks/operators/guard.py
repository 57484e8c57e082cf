"""Benchmark guard: exact, structural and containment matches, and the removal of whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import code

#: Prompts of fewer characters are too general to search for.
MIN_PROMPT = 20
#: Most tokens in a row by which a prompt is found, and characters of a long token by which one of one or two tokens is.
ANCHOR, PIECE = 6, 10
#: Signatures and anchors are broadcast up to so many rows (of under 100 bytes).
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast if its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def signatures(samples: DataFrame, code_col: str) -> DataFrame:
    """(family, sig) of benchmark code: exact, and structural from MIN_STRUCTURAL characters on."""
    texts = samples.where(F.trim(code_col) != "").select(code.normalized(F.col(code_col)).alias("n"), code.structural(F.col(code_col)).alias("s"))
    exact = texts.where("n <> ''").select(F.lit("exact").alias("family"), code.signature(F.col("n")).alias("sig"))
    shape = texts.where(F.length("s") >= code.MIN_STRUCTURAL).select(F.lit("structural").alias("family"), code.signature(F.col("s")).alias("sig"))
    return exact.union(shape).distinct()


def blocked_by_code(records: DataFrame, sigs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, reason) of records whose fenced blocks have a signature of the blocklist."""
    blocks = records.select(id_col, F.explode(code.fences(F.col(text_col))).alias("block")).where(F.trim("block") != "")
    known = signatures_of_rows(blocks, id_col, "block")
    return known.join(small(sigs), ["family", "sig"], "left_semi").select(id_col, F.concat(F.lit("code:"), "family").alias("reason")).distinct()


def signatures_of_rows(rows: DataFrame, id_col: str, code_col: str) -> DataFrame:
    texts = rows.select(id_col, code.normalized(F.col(code_col)).alias("n"), code.structural(F.col(code_col)).alias("s"))
    both = F.array(F.struct(F.lit("exact").alias("family"), code.signature(F.col("n")).alias("sig")), F.when(F.length("s") >= code.MIN_STRUCTURAL, F.struct(F.lit("structural").alias("family"), code.signature(F.col("s")).alias("sig"))))
    return texts.select(id_col, F.explode(F.array_compact(both)).alias("f")).select(id_col, "f.family", "f.sig")


def _key(size: int | Column, part: Column) -> Column:
    return F.xxhash64(F.lit(size).cast("int") if isinstance(size, int) else size.cast("int"), part)


def _windows(items: Column, size: int, tag: int) -> Column:
    """Keys of all runs of so many items; none in a shorter array."""
    return F.when(F.size(items) >= size, F.transform(F.sequence(F.lit(1), F.size(items) - size + 1), lambda i: _key(tag, F.slice(items, i, size)))).otherwise(F.array().cast("array<bigint>"))


def _hashes(items: Column) -> Column:
    return F.transform(items, lambda x: F.xxhash64(x))


def contains_prompt(texts: DataFrame, prompts: DataFrame, id_col: str, text_col: str, prompt_col: str) -> DataFrame:
    """(id, prompt) pairs where the text's normalised tokens contain the prompt's as a string. Rows without id are not told.

    No text is compared with a prompt that no key leads to. A prompt may begin and end inside tokens of the text, but its inner
    tokens are whole ones there: its key is the hash of up to ANCHOR of them in a row. A prompt of one or two tokens has one of
    PIECE characters or more, whose first PIECE are its key. Texts give keys of such lengths alone as prompts have, and (id, key)
    rows without the text meet them in an equi-join; the text is fetched and searched once for each pair found.
    """
    p = prompts.select(code.normalized(F.col(prompt_col)).alias("prompt")).where(F.length("prompt") >= MIN_PROMPT).distinct()
    words = F.split("prompt", " ")
    p = p.withColumn("size", F.greatest(F.least(F.size(words) - 2, F.lit(ANCHOR)), F.lit(0)))
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    p = p.withColumn("key", F.when(F.col("size") > 0, _key(F.col("size"), F.slice(_hashes(words), F.lit(2), F.col("size")))).otherwise(_key(0, F.slice(_hashes(F.split(longest, "")), 1, PIECE))))
    sizes = sorted(r[0] for r in p.select("size").distinct().collect())  # ANCHOR + 1 rows at most
    t = texts.select(id_col, code.tokens(F.col(text_col)).alias("words")).where("words IS NOT NULL")
    t = t.withColumn("hashes", _hashes(F.col("words")))  # a column of its own, so that no lambda reads the text again
    keys = [_windows(F.col("hashes"), n, n) for n in sizes if n]
    rows = t.select(id_col, F.explode(F.array_distinct(F.concat(*keys)) if keys else F.array().cast("array<bigint>")).alias("key"))
    if 0 in sizes:
        long = texts.select(id_col, F.explode(F.array_distinct(F.filter(code.tokens(F.col(text_col)), lambda w: F.length(w) >= PIECE))).alias("w")).select(id_col, _hashes(F.split("w", "")).alias("chars"))
        rows = rows.union(long.select(id_col, F.explode(_windows(F.col("chars"), PIECE, 0)).alias("key")))
    found = rows.join(small(p.select("key", "prompt")), "key").select(id_col, "prompt").distinct()
    both = texts.select(id_col, F.col(text_col).alias("text")).join(found, id_col)
    return both.where(F.contains(code.normalized(F.col("text")), F.col("prompt"))).select(id_col, "prompt").distinct()


def drop_groups(records: DataFrame, blocked: DataFrame, id_col: str, group_col: str) -> DataFrame:
    """records without any group of which a member is blocked."""
    bad = records.join(blocked.select(id_col).distinct(), id_col, "left_semi").select(group_col).distinct()
    return records.join(bad, group_col, "left_anti")
