"""Column expressions on inline texts."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltworks.functions import code, prose


def apply(spark, expression, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, x string").coalesce(1)
    return [r[0] for r in rows.orderBy("id").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("We utilize it in order to win.", "We use it to win."),
        ("The reader — a user — confirms", "The reader, a user, confirms"),
        ("One – two", "One. two"),
        ("First; second", "First. second"),
        ("This may fail", "This can fail"),
        ("It should not fail", "It should not fail"),
        ("a  \t b , c", "a b, c"),
        ("Simply.\n\n. Go", "Go"),
        ("", ""),
        ("Robust", ""),
    ],
)
def test_sanitize(spark, given, wanted):
    assert apply(spark, prose.sanitize, [given]) == [wanted]


def test_style_violations(spark):
    got = apply(spark, prose.style_violations, ["a — b; it may", "could be", "Seamlessly robust", "", None])
    assert got == [["em-dash", "semicolon", "hedge-modal"], [], ["slop:seamless", "slop:robust"], [], []]


def test_redaction(spark):
    got = apply(spark, prose.redact_secrets, ['token = "abcdefgh1"', "Token := Something", "password=short", "api_key: AAAABBBB, x"])
    assert got == ["[REDACTED]", "Token := Something", "password=short", "[REDACTED], x"]


def test_clean_text(spark):
    rows = [(0, b"fine"), (1, b"\x7fELF...."), (2, b"\xff\xfea"), (3, b"\xc3("), (4, b"  \n"), (5, b"a\x00" * 50), (6, b"\x00abc"), (7, b"token=abcdefgh9")]
    got = spark.createDataFrame(rows, "id int, c binary").orderBy("id").select(prose.clean_text(F.col("c"))).collect()
    assert [r[0] for r in got] == ["fine", None, None, None, None, None, None, "[REDACTED]"]


def test_clean_markdown_keeps_fences(spark):
    got = apply(spark, prose.clean_markdown, ["We **utilize** this; yes\n```ada\nx; y — z\n```\nDone — ok"])
    assert got == ["We use this. yes\n\n```ada\nx; y — z\n```\n\nDone. ok"]


def test_tokens_and_signatures(spark):
    a = 'procedure Add (X : Integer) is -- note\nbegin Put ("a--b"); Y := \'c\'; end Add;'
    got = apply(spark, code.normalized, [a, "", "X'First 1_000.5 <= É"])
    assert got[0] == 'procedure add ( x : integer ) is begin put ( S ) ; y := S ; end add ;' and got[1] == "" and got[2] == "x S first 1_000.5 <= é"
    one, two, three = apply(spark, code.structural, [a, a.replace("Add", "Sum").replace("X", "Zed").upper(), a.replace("Y", "X")])
    assert one == two != three and one.startswith("procedure N1 ( N2 : N3 ) is begin N4 (")


def test_renamed_texts_leave_in_pieces():
    """A large batch is never held as Python strings, nor its result as one array: pieces are of bounded size, in order, nulls included."""
    texts = [None if k % 7 == 0 else "" if k % 7 == 1 else f"procedure a{k} is begin " + f"b{k % 3} := a{k} ; x " * 5000 for k in range(60)]
    pieces = list(code._renamed.func(iter([pa.array(texts), pa.array([], pa.string()), pa.array(texts[:3])])))
    assert max(p.nbytes for p in pieces) < 2 * code.PIECE_CHARS < sum(p.nbytes for p in pieces)
    want = [t if not t else "procedure N1 is begin " + " ".join(["N2 := N1 ; N3"] * 5000) for t in texts]
    assert [t for p in pieces for t in p.to_pylist()] == want + want[:3]
    many = list(code._renamed.func(iter([pa.array(["x"] * 2500)])))
    assert [len(p) for p in many] == [1000, 1000, 500]


@pytest.mark.parametrize(
    ("text", "label"),
    [("X := 1;", "Unknown"), ("with Pre => A", "Ada 2012"), ("-- Pre => A", "Unknown"), ('S := "Pre => A";', "Unknown"), ("pragma SPARK_Mode; Pre => A", "Ada 2012"), ("pragma SPARK_Mode;", "SPARK 2014"), ("[..]'Reduce (X)", "Ada 2022"), ("type T is interface", "Ada 2005"), ("tagged", "Ada 95"), ("package P is procedure Q;", "Ada 83")],
)
def test_standard(spark, text, label):
    assert apply(spark, code.standard, [text]) == [label]


def test_replies(spark):
    block = "File: src/a.ads\n```ada\npackage A is end A;\n```\nFile: /etc/b.ads\n```\nx\n```\nFile: ../c.adb\n```\ny\n```\nFile: other/d.adb\n```\nz\n```"
    body = "```ada\n-- lead\n\npackage body A is\nend A;\n```"
    assert apply(spark, code.reply_format, [block, body, "words", "File: notes.txt\n```\nx\n```"]) == ["file_blocks", "fenced_block", "raw_text", "fenced_block"]
    parse = lambda files: lambda c: code.parse_reply(c, F.lit("src/a.ads"), F.array(*map(F.lit, files)).cast("array<string>"))
    assert apply(spark, parse(["src/a.adb"]), [block, body, "raw", " ", "File: other/d.adb\n```\nz\n```"]) == [{"src/a.ads": "package A is end A;\n"}, {"src/a.adb": "-- lead\n\npackage body A is\nend A;\n"}, {"src/a.ads": "raw\n"}, {}, {"src/a.ads": "z\n"}]
    assert apply(spark, parse([]), [body]) == [{"src/a.ads": "-- lead\n\npackage body A is\nend A;\n"}]


def test_small_helpers(spark):
    assert apply(spark, code.slug, ["## What's new: a  b", "Ünï_code-x!"]) == ["whats-new-a--b", "ünï_code-x"]
    assert apply(spark, code.normalise_lines, ["\r\na  \r\nb\t\rc\n\n"]) == ["a\nb\nc"]
    assert apply(spark, lambda c: code.duration(c.cast("int")), ["45", "725", "3840"]) == ["45s", "12m05s", "1h04m"]
    assert apply(spark, lambda c: code.percent(c.cast("int"), F.lit(3)), ["1", "0"]) == [33.3, 0.0]
    assert apply(spark, lambda c: code.percent(F.lit(1), c.cast("int")), ["0"]) == [None]
    assert apply(spark, lambda c: code.package_name(c, F.lit("stem")), ["package body Foo is", "x"]) == ["Foo", "stem"]
    assert random.Random(1)
