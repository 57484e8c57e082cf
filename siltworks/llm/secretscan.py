"""Secret scanning: candidates by patterns, false positives removed by a random forest. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.common import text_of

_WORDS = "password|passwd|passphrase|secret|api_?key|token|private_?key|access_?key|auth|bearer|credential|pwd"
# What a candidate looks like. Possessive, so that long texts take linear time.
# A value is what follows an announcing word (the rest of its name and a closing quote may come between) and a separator: all
# of a quoted one, else up to a blank. A token is any run of 16 or more characters, but for one character again and again.
PATTERNS = {
    "assignment": rf"""(?i)(?:(?:{_WORDS})[A-Za-z0-9_.\-]{{0,40}}+['"\])]{{0,2}}+\s*+(?:=>|:=|[:=])|bearer\s)\s*+['"]?+((?<=['"])[^'"\n]{{8,}}+|(?<!['"])[^\s'",;]{{8,}}+)""",
    "long_token": r"(?<![A-Za-z0-9+/_-])((?!(.)\2*+(?![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{16,}+={0,2}+)",
}
#: Words that stand for no secret when they are in a value, and those that announce one, or none, near it.
DICTIONARY = ("password", "secret", "token", "example", "sample", "test", "dummy", "changeme", "your", "here", "admin", "user", "name", "demo", "null", "none", "default", "value", "key", "insert", "placeholder", "letmein", "qwerty", "abc", "foo", "bar")
_HARMLESS = "commit|sha1|sha256|md5|checksum|hash|uuid|guid|order|card|phone|invoice|isbn|version|revision|serial|doi|digest"
ANNOUNCING = rf"(?i)({_WORDS})s?(?:[_.-][a-z0-9]{{1,20}}){{0,2}}\W{{0,6}}$"
DENYING = rf"(?i)({_HARMLESS})\W{{0,6}}$"
#: The same words behind a value, with up to four small words between.
_THEN = r"(?i)^\W{0,6}(?:(?:is|was|as|the|a|an|new|its|our|my)\W{1,3}){0,4}"
ANNOUNCING_AFTER, DENYING_AFTER = rf"{_THEN}(?:{_WORDS})", rf"{_THEN}(?:{_HARMLESS})"
HARMLESS_PATH = r"(?i)(test|example|fixture|sample|mock|docs?/|readme|tutorial)"
#: Characters of a finding's surroundings that are looked at.
NEAR = 40
FEATURES = ("length", "digits", "uppers", "transitions", "repeats", "variety", "hex_only", "digits_only", "dashes", "covered", "announced", "denied", "announced_after", "denied_after", "harmless_path")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc_id, kind, value, path, before, after, occurrences: one row for each different value of a document's whole text.

    A value that several patterns find has the first one's kind. before, after: up to NEAR characters on both sides of its most
    telling place: the first that is announced before it, else behind it, else the first that is denied on neither side, else the first. Null and empty texts have no candidate; repeated rows give theirs again. Other columns are not read.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), path.alias("path"))
    found = {k: F.array_distinct(F.regexp_extract_all("text", F.lit(p), 1)) for k, p in PATTERNS.items()}
    rows = rows.select("*", *(c.alias(k) for k, c in found.items()))
    first, second = PATTERNS
    tagged = F.concat(
        F.transform(first, lambda v: F.struct(F.lit(first).alias("kind"), v.alias("value"))),
        F.transform(F.array_except(second, first), lambda v: F.struct(F.lit(second).alias("kind"), v.alias("value"))),
    )
    each = rows.where(f"size({first}) + size({second}) > 0").select("doc_id", "path", "text", F.explode(tagged).alias("f"))
    literal = F.concat(F.lit(r"\Q"), F.replace(F.col("f.value"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    each = each.withColumn("between", F.split("text", literal, -1)).drop("text")
    def place(x, k):
        behind = F.get("between", k + 1)
        before = F.right(F.when(k > 0, F.concat("f.value", x)).otherwise(x), F.lit(NEAR))
        last = k == F.size("between") - 2
        return F.struct(before.alias("before"), F.left(F.when(last, behind).otherwise(F.concat(behind, "f.value")), F.lit(NEAR)).alias("after"))

    each = each.withColumn("places", F.transform(F.slice("between", F.lit(1), F.size("between") - 1), place)).drop("between")
    first_of = lambda keep: F.get(F.filter("places", keep), F.lit(0))
    before, after = lambda p: lambda x: x["before"].rlike(p), lambda p: lambda x: x["after"].rlike(p)
    free = lambda x: ~x["before"].rlike(DENYING) & ~x["after"].rlike(DENYING_AFTER)
    best = F.coalesce(first_of(before(ANNOUNCING)), first_of(after(ANNOUNCING_AFTER)), first_of(free), F.get("places", F.lit(0)))
    each = each.select("doc_id", "f.kind", "f.value", "path", best.alias("best"), F.size("places").cast("long").alias("occurrences"))
    return each.select("doc_id", "kind", "value", "path", "best.before", "best.after", "occurrences")


def with_features(found: DataFrame) -> DataFrame:
    """found(value, path, before, after) with FEATURES: length, character transitions, dictionary coverage, path, neighbouring words."""
    v: Column = F.col("value")
    size = F.greatest(F.length(v), F.lit(1)).cast("double")
    left = lambda pattern: F.length(F.regexp_replace(v, pattern, "")).cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]+", "\u0001"), "[A-Z]+", "\u0002"), "[a-z]+", "\u0003"), "[^\u0001-\u0003]+", "\u0004")
    letters = F.array_distinct(F.split(v, ""))
    words = "(?i)" + "|".join(DICTIONARY)
    made = {
        "length": size,
        "digits": 1 - left("[0-9]") / size,
        "uppers": 1 - left("[A-Z]") / size,
        "transitions": F.length(classes) / size,
        "repeats": 1 - left(r"(.)(?=\1)") / size,
        "variety": F.size(letters) / size,
        "hex_only": v.rlike("^[0-9a-fA-F]+$").cast("double"),
        "digits_only": v.rlike("^[0-9]+$").cast("double"),
        "dashes": (1 - left("[-_]") / size),
        "covered": 1 - F.length(F.regexp_replace(v, words, "")) / size,
        "announced": F.col("before").rlike(ANNOUNCING).cast("double"),
        "denied": F.col("before").rlike(DENYING).cast("double"),
        "announced_after": F.col("after").rlike(ANNOUNCING_AFTER).cast("double"),
        "denied_after": F.col("after").rlike(DENYING_AFTER).cast("double"),
        "harmless_path": F.col("path").rlike(HARMLESS_PATH).cast("double"),
    }
    return found.select("*", *(made[k].cast("double").alias(k) for k in FEATURES))


def labelled_findings(spark: SparkSession, n: int = 4_000) -> DataFrame:
    """n labelled findings (value, path, before, after, label), made by rule: half real-looking secrets, half usual false positives.

    No table of labelled findings is at hand; one with these columns can be given to fit() instead.
    """
    rows = spark.range(0, n, 1, 2)
    h = lambda k: F.sha2(F.concat(F.lit(f"{k}-"), F.col("id").cast("string")), 512)
    pick = lambda k, options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(options))) + 1).cast("int"))
    number = lambda k, lo, hi: (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(hi - lo + 1)) + lo).cast("int")
    base64 = F.regexp_replace(F.base64(F.unhex(h(1))), r"\s|=", "")
    hexes, digits = h(2), F.translate(h(3), "abcdef", "012345")
    dashed = F.concat_ws("-", F.substr(hexes, F.lit(1), F.lit(8)), F.substr(hexes, F.lit(9), F.lit(4)), F.substr(hexes, F.lit(13), F.lit(4)), F.substr(hexes, F.lit(17), F.lit(4)), F.substr(hexes, F.lit(21), F.lit(12)))
    cut = lambda c, lo, hi: F.substr(c, F.lit(1), number("cut", lo, hi))
    told, plain, denied = ("password=", 'token = "', "secret: ", "api_key=", "private_key: ", "auth bearer ", "pwd="), ("and then the ", "value ", "see ", "", "of the new "), ("commit ", "sha256: ", "checksum ", "uuid ", "order ", "card ", "phone ", "serial ", "md5 ", "invoice ")
    paths, harmless = ("src0", "src7/config", "app/settings", "deploy/env"), ("tests/unit", "docs/readme", "examples/a", "fixtures/b")
    letters, base32 = F.regexp_replace(base64, "[^A-Za-z]", ""), F.regexp_replace(F.upper(base64), "[^A-Z2-7]", "")
    plain_words, code_words = ("hunter", "correct", "horse", "battery", "dragon", "summer", "monkey", "p@ssw0rd", "sunshine"), ("get", "Value", "Handler", "config", "module", "Service", "main", "build", "Index", "Request")
    syllables = ("er", "ti", "on", "ein", "heit", "sch", "ver", "lich", "ment", "que", "an", "the", "ing", "ation")
    joined = lambda name, words, n, *by: F.replace(F.concat_ws("\u0001", *(pick(f"{name}{k}", words) for k in range(n))), F.lit("\u0001"), pick(name, by))
    case = F.pmod(F.xxhash64(F.lit("case"), "id"), F.lit(15))
    kinds = [
        (cut(hexes, 16, 64), pick("b", told), pick("p", paths), 1),
        (cut(base64, 20, 60), pick("b", told), pick("p", paths), 1),
        (F.concat(pick("x", ("AKIA", "ghp_", "sk_live_", "xoxb-")), cut(base64, 16, 40)), pick("b", told + plain), pick("p", paths), 1),
        (cut(hexes, 16, 40), pick("b", told), pick("p", paths), 1),
        (cut(base64, 30, 60), pick("b", plain), pick("p", paths), 1),
        (cut(hexes, 32, 64), pick("b", denied), pick("p", paths), 0),
        (cut(digits, 12, 20), pick("b", plain + denied), pick("p", paths), 0),
        (dashed, pick("b", denied + plain), pick("p", paths), 0),
        (F.concat_ws("_", pick("w1", DICTIONARY), pick("w2", DICTIONARY), pick("w3", DICTIONARY), number("n", 1, 99).cast("string")), pick("b", told + plain), pick("p", paths + harmless), 0),
        (F.when(F.col("id") % 2 == 0, F.repeat(pick("r", ("x", "0", "a1", "ab")), 12)).otherwise(cut(hexes, 16, 40)), F.when(F.col("id") % 2 == 0, pick("b", told)).otherwise(pick("b", plain + denied)), pick("p", harmless), 0),
        (F.concat(F.lit("AKIA"), F.substr(base32, F.lit(1), F.lit(16))), pick("b", told + plain), pick("p", paths), 1),
        (F.concat(pick("x", ("ghp_", "", "glpat-")), cut(letters, 20, 40)), pick("b", told + plain), pick("p", paths), 1),
        (F.concat(joined("pw", plain_words, 2, "", "", "-"), pick("pe", ("", "!", "!xyz", "2024", "@1"))), pick("b", told), pick("p", paths), 1),
        (F.when(F.col("id") % 2 == 0, F.initcap(joined("sy", syllables, 7, ""))).otherwise(joined("sy", syllables, 7, "")), pick("b", plain), pick("p", paths), 0),
        (joined("co", code_words, 4, "", "_", "/", "-"), pick("b", plain + denied), pick("p", paths), 0),
    ]
    neutral = ("", " and then", "\n", " ends.", '" for all', ", which", "; the")
    behind = {1: (*neutral, " is the password", " as the new token"), 0: (*neutral, " is the commit", " was its checksum")}
    parts = [rows.where(case == k).select("id", v.alias("value"), b.alias("before"), pick("a", behind[y]).alias("after"), p.alias("path"), F.lit(float(y)).alias("label")) for k, (v, b, p, y) in enumerate(kinds)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit(findings: DataFrame, trees: int = 40, depth: int = 8) -> RandomForestClassificationModel:
    """A random forest on FEATURES from findings(value, path, before, after, label); rows with nulls are left out."""
    rows = with_features(findings.dropna(subset=["value", "path", "before", "after", "label"]))
    made = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7).fit(made.select("features", "label"))


def scan(docs: DataFrame, model: RandomForestClassificationModel, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc_id, kind, value, occurrences, score, is_secret: the candidates with the forest's verdict (score >= 0.5)."""
    rows = with_features(candidates(docs, id_col, text_col, path_col))
    made = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    score = F.round(vector_to_array("probability")[1], 6)
    return made.select("doc_id", "kind", "value", "occurrences", score.alias("score"), (score >= 0.5).alias("is_secret"))
