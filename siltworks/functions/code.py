"""Lexing, signatures and classification of source code, and of model replies."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The language's reserved words, which renaming never touches.
KEYWORDS = tuple(
    """abort abs abstract accept access aliased all and array at begin body case constant declare delay delta digits do else elsif
    end entry exception exit for function generic goto if in interface is limited loop mod new not null of or others out
    overriding package parallel pragma private procedure protected raise range record rem renames requeue return reverse
    select separate some subtype synchronized tagged task terminate then type until use when while with xor""".split()
)
_RESERVED = frozenset(KEYWORDS)
# Fixed value: tokens for signatures - string, comment, character, word, number, operator, other.
TOKEN = r""""(?:[^"]|"")*"|--[^\n]*|'(?:[^'\n]|'')'|[A-Za-z][A-Za-z0-9_]*|\d[\d_]*(?:\.\d[\d_]*)?|\.\.|:=|=>|<=|>=|/=|<<|>>|<>|\*\*|\S"""
# Fixed value: tokens for scoring - case and comments stay.
SCORE_TOKEN = r"""'(?:[^']|'')+'|"(?:[^"]|"")*"|[A-Za-z][A-Za-z0-9_]*|\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|\*\*|:=|<=|>=|/=|<>|=>|\.\.|<<|>>|[^\s]"""
#: Structural signatures of fewer characters are too general to use.
MIN_STRUCTURAL = 40
#: Renamed texts leave the Python worker in pieces of so many characters or rows.
PIECE_CHARS, PIECE_ROWS = 1_000_000, 1_000

# Features of each language standard with their weights; the first standard whose features weigh 2 or more wins.
STANDARDS = (
    ("Ada 2022", ((r"(?i)\bReduce\s*\(", 2), (r"(?i)\bPut_Image\b", 1), (r"(?i)\bparallel\s+(do|block|and|loop)\b", 2), (r"(?i)\bwith\s+delta\b", 2), (r"(?i)\b'Update\s*=>", 2), (r"(?i)\bStatic_Predicate\b", 2), (r"(?i)\bselect\s+[^;]+\s+then\s+abort\b", 2))),
    ("Ada 2012", ((r"(?i)\bPre\s*=>", 2), (r"(?i)\bPost\s*=>", 2), (r"(?i)\bType_Invariant('Class)?\s*=>", 2), (r"(?i)\bGlobal\s*=>", 2), (r"(?i)\bDepends\s*=>", 2), (r"(?i)\b(Dynamic_)?Predicate('Class)?\s*=>", 2), (r"(?i)\(\s*for\s+(all|some)\b", 2), (r"(?i)\(\s*if\s[^()]*\bthen\s[^()]*\belse\b", 2), (r"(?i)\(\s*case\s[^()]+\bis\s[^()]+\bwhen\b", 2), (r"(?i)\(\s*declare\b", 2), (r"(?i)\bfunction\s+[\w.]+\s*(\([^)]*\))?\s*(return\s+[\w.]+\s*)?is\s*\(", 2), (r"(?i)\bfor\s+\w+\s+of\b", 2), (r"(?i)\bWide_Wide_\w", 1))),
    ("SPARK 2014", ((r"(?i)\bSPARK_Mode\b", 2), (r"(?i)\bLoop_Invariant\b", 2), (r"(?i)\bLoop_Variant\b", 2), (r"(?i)\bContract_Cases\b", 2), (r"(?i)\bLoop_Entry\b", 2), (r"(?i)\bRelaxed_Initialization\b", 2), (r"(?i)\bGhost\b", 1), (r"(?i)\bpragma\s+(Assume|Assert_And_Cut|Guard)\b", 1), (r"\bgnatprove\b", 1))),
    ("Ada 2005", ((r"(?i)\btype\s+\w+\s+is\s+interface\b", 2), (r"(?i)\boverriding\b", 1), (r"\bAda\.Containers\b", 2), (r"(?i)\buse\s+type\b", 1), (r"(?i)\bis\s+null\s*;", 1), (r"(?i)\bnot\s+null\s+access\b", 2), (r"(?i)\bpragma\s+Assert\b", 1))),
    ("Ada 95", ((r"(?i)\btagged\b", 2), (r"(?i)\babstract\s+(tagged|type)\b", 1), (r"(?i)\bpackage\s+(body\s+)?\w+\.\w+\s+is\b", 2), (r"\bAda\.Finalization\.(Root_)?(Limited_)?Controlled\b", 2), (r"(?i)\bprotected\s+(type|body)\b", 2), (r"(?i)\baliased\b", 1), (r"\bWide_(String|Character|Text)\b", 1))),
    ("Ada 83", ((r"(?i)\bpackage\s+\w+\s+is\b", 1), (r"(?i)\bpackage\s+body\b", 1), (r"(?i)\b(procedure|function)\s+\w+", 1), (r"(?i)\bpragma\s+\w+", 1), (r"(?i)\btask\s+(body\s+)?\w+", 1))),
)
# Markers by which output is graded against its standard.
MARKERS = {
    "SPARK 2014": ("SPARK_Mode", "Ghost", "GNATprove"),
    "Ada 2022": ("Static_Pure", "Pure_Global", "Contract_Cases"),
    "Ada 2012": ("Pre =>", "Post =>", "Type_Invariant"),
    "Ada 2005": ("interfaces", "aliased"),
    "Ada 95": ("tagged", "abstract", "override"),
    "Ada 83": ("procedure", "function", "package body"),
}
FENCE = r"(?s)```(?:ada)?\n(.*?)```"


def strip_comments(code: Column) -> Column:
    """Without comments and the contents of strings, in this order."""
    return F.regexp_replace(F.regexp_replace(code, r"--[^\n]*", " "), r'"(?:[^"]|"")*"', '""')


def standard(code: Column) -> Column:
    """The first standard, newest tier first, whose features weigh enough, else Unknown."""
    plain, out = strip_comments(code), None
    for name, features in STANDARDS:
        enough = sum((F.when(plain.rlike(p), w).otherwise(0) for p, w in features), F.lit(0)) >= 2
        out = F.when(enough, name) if out is None else out.when(enough, name)
    return out.otherwise("Unknown")


def compliance(code: Column, of_standard: Column) -> Column:
    """Share of the standard's markers that the code has."""
    out = F.lit(0.0)
    for name, markers in MARKERS.items():
        hits = sum((F.when(F.contains(code, F.lit(m)), 1).otherwise(0) for m in markers), F.lit(0))
        out = F.when(of_standard == name, hits / len(markers)).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Tokens without comments; strings and characters are `S`, words in lower case."""
    found = F.filter(F.regexp_extract_all(text, F.lit(TOKEN), 0), lambda t: ~t.startswith("--"))
    return F.transform(found, lambda t: F.when(t.startswith('"') | (t.startswith("'") & (F.length(t) <= 3)), "S").when(t.rlike(r"^[\p{L}_]"), F.lower(t)).otherwise(t))


def normalized(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


class _Names(dict):
    """Tokens as renamed: a new word that isn't reserved gets the next number."""

    count = 0

    def __missing__(self, token: str) -> str:
        word = token not in _RESERVED and (token[0].isalpha() or token[0] == "_")
        self.count += word
        self[token] = name = f"N{self.count}" if word else token
        return name


def _rename(text: str) -> str:
    return " ".join(map(_Names().__getitem__, filter(None, text.split(" "))))


@F.arrow_udf(T.StringType())
def _renamed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Only a batch's Arrow memory (64 MB by Spark's setting, or one longer text) is held whole: its texts become strings one at a time, and leave in pieces."""
    for texts in batches:
        piece, size = [], 0
        for x in texts:
            text = x.as_py()
            piece.append(None if text is None else _rename(text))
            size += len(piece[-1] or "")
            if size >= PIECE_CHARS or len(piece) >= PIECE_ROWS:
                yield pa.array(piece, pa.string())
                piece, size = [], 0
        yield pa.array(piece, pa.string())


def structural(text: Column) -> Column:
    """Tokens with the n-th different word that isn't reserved as Nn: equal for renamed copies only.

    The lexer is a built-in expression; numbering words is linear in Python and
    quadratic as an expression on arrays, so only that runs in an Arrow batch function.
    """
    return _renamed(normalized(text))


def signature(text: Column) -> Column:
    return F.sha2(text, 256)


def fences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FENCE), 1)


def normalise_lines(code: Column) -> Column:
    """Line ends as \\n, no blanks at the ends of lines and of the whole."""
    code = F.regexp_replace(F.regexp_replace(code, r"\r\n?", "\n"), r"[^\S\n]+(?=\n|$)", "")
    return F.regexp_replace(code, r"^\s+|\s+$", "")


def package_name(code: Column, stem: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(code, r"(?i)package\s+(?:body\s+)?(\w+)\s+is", 1), F.lit("")), stem)


def looks_like_unit(code: Column) -> Column:
    return code.rlike(r"\b(?:procedure|function|package(\s+body)?|generic|task(\s+body)?|protected(\s+body)?)\b")


def looks_like_code(block: Column) -> Column:
    """Whether a block holds any of the fixed words and signs of the language."""
    words = ("procedure", "function", "package", "task", "protected", "is begin", "end ", ":=", "with ", "type ", "subtype ")
    low = F.lower(block)
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


#: A file of a reply: its path and the fenced block after it.
FILE_BLOCK = r"(?s)File:\s*(\S+)\s*\n+```[^\n]*\n(.*?)```"


def reply_files(reply: Column) -> Column:
    """Array of (path, body) of the usable files that a reply names, in its order."""
    paths, bodies = (F.regexp_extract_all(reply, F.lit(FILE_BLOCK), k) for k in (1, 2))
    both = F.zip_with(paths, bodies, lambda p, b: F.struct(safe_path(p).alias("path"), F.concat(F.regexp_replace(b, r"^\s+|\s+$", ""), F.lit("\n")).alias("body")))
    return F.filter(both, lambda f: f["path"].isNotNull())


def reply_format(reply: Column) -> Column:
    return F.when(F.size(reply_files(reply)) > 0, "file_blocks").when(F.contains(reply, F.lit("```")), "fenced_block").otherwise("raw_text")


def opens_with_body(code: Column) -> Column:
    """Whether the first line that is neither blank nor a comment opens a package body."""
    lines = F.filter(F.transform(F.split(code, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("--"))
    return F.coalesce(F.get(lines, F.lit(0)).rlike(r"(?i)^package\s+body\b"), F.lit(False))


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def parse_reply(reply: Column, default_path: Column, project_files: Column) -> Column:
    """Map of path to content: files beside default_path, else the fenced or whole reply there, or at its body file if it opens a body and the project has that file."""
    beside = F.filter(reply_files(reply), lambda f: parent_dir(f["path"]) == parent_dir(default_path))
    paths = F.array_distinct(F.transform(beside, lambda f: f["path"]))
    overlay = F.map_from_arrays(paths, F.transform(paths, lambda p: F.element_at(F.filter(beside, lambda f: f["path"] == p), -1)["body"]))
    code = reply_code(reply)
    sibling = F.regexp_replace(default_path, r"\.ads$", ".adb")
    routed = (sibling != default_path) & F.coalesce(F.array_contains(project_files, sibling), F.lit(False)) & opens_with_body(code)
    fallback = F.create_map(F.when(routed, sibling).otherwise(default_path), F.concat(code, F.lit("\n")))
    blank = F.trim(F.regexp_replace(reply, r"\s+", " ")) == ""
    return F.when(blank, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).when(F.size(beside) > 0, overlay).otherwise(fallback)


def reply_code(reply: Column) -> Column:
    """The first fenced block of the language, else the first of any, else the reply itself."""
    own = F.regexp_extract(reply, r"(?s)```ada\s*\n(.*?)```", 1)
    any_fence = F.regexp_extract(reply, r"(?s)```\s*\n(.*?)```", 1)
    return F.regexp_replace(F.coalesce(F.nullif(own, F.lit("")), F.nullif(any_fence, F.lit("")), reply), r"^\s+|\s+$", "")


def safe_path(path: Column) -> Column:
    """The path without quotes and closing punctuation; null if absolute, empty, climbing or not of a source type."""
    clean = F.regexp_replace(F.trim(path), r"^[`\"':;,.]+|[`\"':;,.]+$", "")
    bad = (clean == "") | clean.startswith("/") | F.array_contains(F.split(clean, "/"), "..") | ~clean.rlike(r"[^/]\.(ads|adb|gpr|adc)$")
    return F.when(~bad, clean)


def slug(title: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.trim(title)), r"^#{1,6}\s+", "")
    return F.replace(F.trim(F.regexp_replace(bare, r"(?U)[^\w\- ]", "")), F.lit(" "), F.lit("-"))


def percent(hits: Column, total: Column, digits: int = 1) -> Column:
    """Half-even percentage, null for no total: not measured is not zero."""
    return F.when(total > 0, F.bround(F.lit(100.0) * hits / total, digits))


def duration(seconds: Column) -> Column:
    """45s, 12m05s or 1h04m."""
    s = F.floor(seconds)
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm%02ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))
