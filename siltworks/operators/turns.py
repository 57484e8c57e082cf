"""Chat turns: records, filters, generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions import code, prose


def message(role: str | Column, content: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content"))


def to_records(rows: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One record per conversation with its messages in order."""
    each = F.struct(order, message(F.col("role"), F.coalesce("text", F.lit(""))).alias("m"))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("x")).select(key, F.col("x.m").alias("messages"))


def joined(rows: DataFrame, key: str = "conv_id", order: str = "turn", separator: str = " | ") -> DataFrame:
    """One row per conversation: joined, its whole texts in order, each after its number. Null texts are left out."""
    each = F.struct(order, "role", "text", F.concat(F.col(order).cast("string"), F.lit(":"), F.col("text")).alias("t"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["t"]), separator).alias("joined"))


def last_message(messages: str = "messages") -> Column:
    return F.try_element_at(F.col(messages), F.lit(-1))


def empty_assistant(messages: str = "messages") -> Column:
    last = last_message(messages)
    return F.coalesce((last["role"] == "assistant") & (F.trim(F.coalesce(last["content"], F.lit(""))) == ""), F.lit(False))


def usable(messages: str = "messages") -> Column:
    """Two messages at least, and no empty assistant at the end; another last role is allowed."""
    return F.coalesce(F.size(messages) >= 2, F.lit(False)) & ~empty_assistant(messages)


def style_checked(records: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, at, violations) of assistant messages without a fence that break a style rule."""
    each = records.select(key, F.posexplode(messages).alias("at", "m")).where((F.col("m.role") == "assistant") & ~F.contains("m.content", F.lit("```")))
    return each.select(key, "at", prose.style_violations(F.col("m.content")).alias("violations")).where("size(violations) > 0")


def message_signature(messages: str = "messages") -> Column:
    """A digest of the messages in canonical form: keys sorted."""
    return F.sha2(F.to_json(F.transform(messages, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role")))), 256)


def pick(options: tuple[str, ...], key: Column, hasher=F.crc32) -> Column:
    """One of the options, by the key's content."""
    return F.element_at(F.array(*map(F.lit, options)), (hasher(key) % len(options) + 1).cast("int"))


def declaration_turns(units: DataFrame) -> DataFrame:
    """Up to three turns per declaration(name, kind, text, aspects, body_text): its body, its contract explained, its contract written.

    Without a body or aspects the turns that need them are missing.
    """
    fence = lambda c: F.concat(F.lit("```ada\n"), c, F.lit("\n```"))
    contract = F.array_join(F.transform(F.array_sort(F.map_entries("aspects")), lambda e: F.concat(e["key"], F.lit(" => "), e["value"])), ", ")
    bare = F.regexp_replace(F.regexp_replace("text", r"(?is)\s+with\s+\w+.*$", ";"), r";+$", ";")
    has = F.size(F.coalesce("aspects", F.create_map().cast("map<string,string>"))) > 0
    turn = lambda kind, ask, answer: F.struct(F.lit(kind).alias("kind"), F.array(message("user", ask), message("assistant", answer)).alias("messages"))
    turns = F.array_compact(
        F.array(
            F.when(F.col("body_text").isNotNull(), turn("ast_impl", F.concat(F.lit("Implement this declaration.\n"), fence(F.col("text"))), fence(F.col("body_text")))),
            F.when(has, turn("ast_contract", F.concat(F.lit("State the contract of "), "name", F.lit(".\n"), fence(F.col("text"))), contract)),
            F.when(has, turn("ast_contract_write", F.concat(F.lit("Add the contract "), contract, F.lit(".\n"), fence(bare)), fence(F.col("text")))),
        )
    )
    group = F.concat(F.lit("ast:"), F.crc32("text").cast("string"))
    return units.select(group.alias("group_id"), F.explode(turns).alias("t")).select("group_id", "t.*")


def completion_turns(pairs: DataFrame) -> DataFrame:
    """One turn per pair(spec, impl): a spec to write the body for. A side alone has an empty answer, which usable() drops: nothing in the table completes it."""
    fence = lambda c: F.concat(F.lit("```ada\n"), c, F.lit("\n```"))
    ask = F.when(F.col("spec").isNull(), F.concat(F.lit("Write the specification.\n"), fence(F.col("impl")))).otherwise(F.concat(F.lit("Write the body.\n"), fence(F.col("spec"))))
    label = code.standard(F.coalesce("impl", "spec"))
    return pairs.select("dir", "stem", F.when(label == "Unknown", "Ada").otherwise(label).alias("standard"), F.array(message("user", ask), message("assistant", F.when(F.col("spec").isNotNull() & F.col("impl").isNotNull(), fence(F.col("impl"))).otherwise(""))).alias("messages"))


def ingest_stats(requested: DataFrame, records: DataFrame) -> DataFrame:
    """Per requested file: records, ingested, malformed, empty; a file that isn't there has zeros.

    records(path, messages, bad): bad marks a line that isn't a record.
    """
    n = lambda c, name: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(name)
    bad = F.coalesce("bad", F.lit(False))
    counts = records.groupBy("path").agg(F.count("*").alias("records"), n(~bad & usable(), "ingested"), n(bad, "malformed"), n(~bad & empty_assistant(), "empty"))
    return requested.join(counts, "path", "left").na.fill(0, ["records", "ingested", "malformed", "empty"])


def capped_families(defects: DataFrame, code_hash: str, rank: str, families: int = 17, cap: int = 3, snippet: str = "snippet") -> DataFrame:
    """The first cap applicable families of a snippet, counted from the one that its hash points to."""
    turned = F.pmod(F.col(rank) - F.col(code_hash) % families, F.lit(families))
    w = Window.partitionBy(snippet).orderBy("__turned")
    return defects.withColumn("__turned", turned).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= cap).drop("__turned", "__n")
