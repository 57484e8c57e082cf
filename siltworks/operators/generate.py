"""Generated turns: explained code blocks, lab changes, synthesised contracts, sections."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import code
from siltworks.operators.turns import message, pick

#: What a block shows, by pattern; an explanation names those that it finds, in this order.
CONSTRUCTS = (
    (r"(?i)\bgeneric\b", "a generic unit"), (r"(?i)\bpackage\s+body\b", "a package body"), (r"(?i)\bpackage\s+\w+\s+is\b", "a package specification"), (r"(?i)\btask\b", "a task"),
    (r"(?i)\bprotected\b", "a protected object"), (r"(?i)\b(pre|post)\s*=>", "a contract"), (r"(?i)\bfor\b[^;]*\bloop\b", "a counted loop"), (r"(?i)\bwhile\b[^;]*\bloop\b", "a conditional loop"),
    (r"(?i)\bexception\b", "an exception handler"), (r"(?i)\brecord\b", "a record type"), (r"(?i)\barray\s*\(", "an array type"), (r"(?i)\bpragma\b", "a pragma"),
)
ASK_SECTION = ("Explain {t}.", "What does the section {t} say?", "Summarise {t}.", "Tell me about {t}.", "Describe {t}.")

#: Contract templates: name, specification and body, with {n} for the instance's number and {k} for its constant.
CONTRACTS = (
    ("clamp", "function Clamp_{n} (X : Integer) return Integer\n  with Post => Clamp_{n}'Result <= {k};", "function Clamp_{n} (X : Integer) return Integer is (if X > {k} then {k} else X);"),
    ("scale", "function Scale_{n} (X : Natural) return Natural\n  with Pre => X <= {k}, Post => Scale_{n}'Result = X * 2;", "function Scale_{n} (X : Natural) return Natural is (X * 2);"),
    ("guard", "procedure Set_{n} (V : in out Integer; To : Integer)\n  with Pre => To in 0 .. {k}, Post => V = To;", "procedure Set_{n} (V : in out Integer; To : Integer) is\nbegin\n   V := To;\nend Set_{n};"),
)


def fenced(c: Column) -> Column:
    return F.concat(F.lit("```ada\n"), c, F.lit("\n```"))


def block_turns(blocks: DataFrame) -> DataFrame:
    """Two turns per code block: the block itself on request, and what constructs it shows."""
    b = F.col("block")
    shown = F.array_compact(F.array(*(F.when(b.rlike(p), what) for p, what in CONSTRUCTS)))
    told = F.when(F.size(shown) > 0, F.concat(F.lit("The code shows "), F.array_join(F.slice(shown, 1, 4), ", "), F.when(F.size(shown) > 4, " and others").otherwise(""), F.lit("."))).otherwise("The code shows statements.")
    turn = lambda kind, ask, answer: F.struct(F.lit(kind).alias("kind"), F.array(message("user", ask), message("assistant", answer)).alias("messages"))
    label = F.when(code.standard(b) == "Unknown", "Ada").otherwise(code.standard(b))
    both = F.array(turn("doc_qa", F.concat(F.lit("Show an example in "), label, F.lit(".")), fenced(b)), turn("doc_qa", F.concat(F.lit("Explain this code.\n"), fenced(b)), told))
    return blocks.select(F.concat(F.lit("doc:"), F.crc32("block").cast("string")).alias("group_id"), F.explode(both).alias("t")).select("group_id", "t.*")


def section_turns(sections: DataFrame) -> DataFrame:
    """A turn per usable section(source, title, clean): the wording of the request follows the title's content."""
    name = F.element_at(F.split(F.replace("source", F.lit("\\"), F.lit("/")), "/"), -1)
    ask = F.replace(pick(ASK_SECTION, F.col("title")), F.lit("{t}"), F.col("title"))
    return sections.select(F.lit("doc_section").alias("kind"), name.alias("source"), F.array(message("user", ask), message("assistant", F.col("clean"))).alias("messages"))


def lab_turns(twins: DataFrame) -> DataFrame:
    """Per lab twin(root, lab, rel, prompt, answer): the completed file, and a summary of the lines that it adds."""

    @F.pandas_udf("string")
    def summary(prompt: pd.Series, answer: pd.Series) -> pd.Series:
        def one(a, b):
            added = [x[2:].strip() for x in difflib.ndiff((a or "").splitlines(), (b or "").splitlines()) if x.startswith("+ ") and x[2:].strip()]
            return f"Adds {len(added)} lines" + (f", first: {added[0]}" if added else "") + "."

        return pd.Series([one(a, b) for a, b in zip(prompt, answer, strict=True)])

    turn = lambda ask, answer: F.array(message("user", ask), message("assistant", answer))
    both = F.array(turn(F.concat(F.lit("Complete this file.\n"), fenced(F.col("prompt"))), fenced(F.col("answer"))), turn(F.concat(F.lit("What does the solution change?\n"), fenced(F.col("prompt"))), F.col("told")))
    rows = twins.withColumn("told", summary("prompt", "answer"))
    return rows.select(F.concat(F.lit("lab:"), F.crc32("lab").cast("string")).alias("group_id"), F.lit("lab_pair").alias("kind"), F.explode(both).alias("messages"))


def contract_instances(spark, each: int = 10) -> DataFrame:
    """(template, n, spec, body): each template with so many different constants."""
    table = spark.createDataFrame(list(CONTRACTS), "template string, spec string, body string")
    rows = table.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(each))))
    fill = lambda c: F.replace(F.replace(c, F.lit("{n}"), F.col("n").cast("string")), F.lit("{k}"), (F.col("n") * 37).cast("string"))
    return rows.select("template", "n", fill(F.col("spec")).alias("spec"), fill(F.col("body")).alias("body"))


def contract_turns(instances: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Turns of the instances that the given verdicts(template, n, proved) call proved: write the contract, implement it."""
    good = instances.join(verdicts.where("proved"), ["template", "n"])
    bare = F.regexp_replace("spec", r"(?s)\s+with .*$", ";")
    turn = lambda kind, ask, answer: F.struct(F.lit(kind).alias("kind"), F.array(message("user", ask), message("assistant", answer)).alias("messages"))
    both = F.array(turn("contract_write", F.concat(F.lit("Add a contract.\n"), fenced(bare)), fenced(F.col("spec"))), turn("contract_body", F.concat(F.lit("Implement this.\n"), fenced(F.col("spec"))), fenced(F.col("body"))))
    return good.select(F.concat(F.lit("contract-synth:"), F.crc32("spec").cast("string")).alias("group_id"), "template", F.explode(both).alias("t")).select("group_id", "template", "t.*")


def markdown_table(df: DataFrame, most: int = 1_000) -> str:
    """A small report table; larger ones are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a report page")
    line = lambda cells: "| " + " | ".join("n/a" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *(line(r) for r in rows)])
