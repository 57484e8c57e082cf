"""Generated turns."""

from __future__ import annotations

from siltworks.operators import generate


def test_block_and_section_turns(spark):
    rows = generate.block_turns(spark.createDataFrame([("package P is pragma X; end P;",), ("x",)], "block string")).collect()
    assert len(rows) == 4 and len({r.group_id for r in rows}) == 2
    assert "The code shows a package specification, a pragma." in {r.messages[1].content for r in rows}
    s = generate.section_turns(spark.createDataFrame([("a\\b.md", "T > U", "body")], "source string, title string, clean string")).collect()[0]
    assert s.source == "b.md" and "T > U" in s.messages[0].content and s.messages[1].content == "body"


def test_labs_and_contracts(spark):
    labs = generate.lab_turns(spark.createDataFrame([("r", "l", "m", "a\n", "a\nb := 1;\n")], "root string, lab string, rel string, prompt string, answer string")).collect()
    assert [r.messages[1].content for r in labs][1] == "Adds 1 lines, first: b := 1;."
    made = generate.contract_instances(spark, 2)
    assert made.count() == 2 * len(generate.CONTRACTS)
    verdicts = spark.createDataFrame([("clamp", 1, True), ("clamp", 2, False)], "template string, n int, proved boolean")
    turns = generate.contract_turns(made, verdicts).collect()
    assert len(turns) == 2 and all("Clamp_1" in r.messages[1].content and "{" not in r.messages[1].content for r in turns)


def test_markdown(spark):
    assert generate.markdown_table(spark.createDataFrame([(1, None)], "a int, b string")) == "| a | b |\n| --- | --- |\n| 1 | n/a |"
