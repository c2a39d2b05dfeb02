"""Front matter to rows and back, card trees and inventories read from files, upserts."""

import random

import pytest
from pyspark.sql import functions as F

from quillwort.operators import front_matter as M

CARD = """---
type: issue
title: EXAMPLE 0000 --- [#SR-1] open - a label printed
"odd": x
---
"""
FULL = """---
type: concept # a comment
title: "It's \\"quoted\\": \\n two"
note: 'it''s # no comment'
n: -12
share: 0.5
on_hold: yes
nothing: ~
empty:
tags: [a, "b, c", 'd', e f]
none: []
related:
  - p1/x # why
  - "p2: y"
- p3/z
sources:
  - ref: open-systems-2023
    page: 4
  - ref: 'b'
owner:
  name: Ada
  team: "x"
text: |
  # not a comment
    deeper: [no list

  end
folded: >
  one
  two
# a comment
tags: [last]
---
body: no field
"""
WRONG = ["---\n: : :\n---\n", "---\na: [1, 2\n---\n", '---\na: "open\n---\n', "---\nno key\n---\n", "---\na: x\n  b: y\n---\n", "---\na: {b: c}\n---\n", "no block", "", None, "---\n---\n", "----\na: b\n---\n", "---\na: b\n--- \n"]


def rows(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    return sorted((tuple(r) for r in M.fields(df).collect()), key=str)


def test_fields_of_all_shapes(spark):
    got = {r[1:] for r in rows(spark, [FULL])}
    assert got == {
        ("type", None, None, "concept", "str"), ("title", None, None, 'It\'s "quoted": \n two', "str"), ("note", None, None, "it's # no comment", "str"), ("n", None, None, "-12", "int"), ("share", None, None, "0.5", "float"),
        ("on_hold", None, None, "yes", "bool"), ("nothing", None, None, None, "null"), ("empty", None, None, None, "null"), ("related", 0, None, "p1/x", "str"), ("related", 1, None, "p2: y", "str"), ("related", 2, None, "p3/z", "str"),
        ("sources", 0, "ref", "open-systems-2023", "str"), ("sources", 0, "page", "4", "int"), ("sources", 1, "ref", "b", "str"), ("owner", None, "name", "Ada", "str"), ("owner", None, "team", "x", "str"),
        ("text", None, None, "# not a comment\n  deeper: [no list\n\nend\n", "str"), ("folded", None, None, "one two\n", "str"), ("tags", 0, None, "last", "str"),
    }


def test_fence_counts_on_its_own_line_and_wrong_blocks_give_nothing(spark):
    good = CARD.replace('"odd": x\n', "client: beta\nrelated: []\n")
    assert {r[1:] for r in rows(spark, [good])} == {("type", None, None, "issue", "str"), ("title", None, None, "EXAMPLE 0000 --- [#SR-1] open - a label printed", "str"), ("client", None, None, "beta", "str")}
    assert rows(spark, [*WRONG, CARD]) == []


def test_lists_of_scalars_and_of_lists(spark):
    df = spark.createDataFrame([(1, "---\nrelated: [a, b]\n---\n"), (2, "---\nrelated: c\n---\n"), (3, "---\nrelated:\n---\n")], "id int, text string")
    assert {r["id"]: r["related"] for r in M.listed(M.fields(df), "related").collect()} == {1: ["a", "b"], 2: ["c"]}


@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_values_read_back(spark, seed):
    rng = random.Random(seed)
    values = ["".join(rng.choice("ab: #'\"\\\n-[]{}|>&*!%@`,~01.é中\t") for _ in range(rng.randrange(0, 9))) for _ in range(300)] + ["null", "yes", "12", "1.5", "p1/x", "a - b", " x", "x ", "~"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, v string")
    texts = df.select("id", F.concat(F.lit("---\nk: "), M.quoted("v"), F.lit("\nl:\n  - "), M.quoted("v"), F.lit("\n---\nbody")).alias("text"))
    got = {(r["id"], r["key"]): (r["value"], r["kind"]) for r in M.fields(texts).collect()}
    assert got == {(k, key): (v, "str") for k, v in enumerate(values) for key in "kl"}


def test_stamping_twice_changes_nothing(spark):
    df = spark.createDataFrame([("---\na: b\n---\nbody\n",), ("---\nregime: x\n---\n",), ("no block",)], "t string")
    once = df.select(M.stamped("t", "regime", F.lit("new: one")).alias("t"))
    assert [r["t"] for r in once.collect()] == ['---\na: b\nregime: "new: one"\n---\nbody\n', "---\nregime: x\n---\n", "no block"]
    assert [r["t"] for r in once.select(M.stamped("t", "regime", F.lit("other")).alias("t")).collect()] == [r["t"] for r in once.collect()]


def test_cards_and_inventory_come_from_a_written_tree(spark, tmp_path):
    root = tmp_path / "a tree+é"
    files = {
        "p1/1.md": "---\ntitle: One\nversion: 2023\n---\ntext", "p1/2.md": "no block", "p1/db/tables/x.md": "---\ntitle: X\n---\n", "p1/index.md": "---\ntitle: I\n---\n", "clients/c1/memory/m 1.md": "---\ntitle: M\ntype: concept\nstatus: approved\n---\n",
        "clients/c1/issues/7-a.md": "---\nproduct: p1\n---\n", "clients/c1/other/n.md": "x", "p1/.hidden/h.md": "---\ntitle: H\n---\n", "p1/_gone/g.md": "x", "p2/notes.PDF": "12345", "p2/e%20f.md": "x",
    }
    for path, text in files.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text)
    got = {r["card_id"]: (r["title"], r["type"], r["client"], r["version"], r["status"]) for r in M.card_index(M.card_files(spark, str(root))).collect()}
    assert got == {
        "p1/1": ("One", "concept", None, "2023", None), "p1/2": ("p1/2", "concept", None, None, None), "p2/e%20f": ("p2/e%20f", "concept", None, None, None), "clients/c1/memory/m 1": ("M", "memory", "c1", None, "approved"),
        "clients/c1/issues/7-a": ("c1/issues/7-a", "issue", "c1", None, None),
    }
    seen = {r["path"]: (r["name"], r["ext"], r["size"], r["depth"], r["segments"]) for r in M.file_inventory(spark, str(root)).collect()}
    assert set(seen) == {p for p in files if "hidden" not in p and "_gone" not in p}
    assert seen["p2/notes.PDF"] == ("notes.PDF", ".pdf", 5, 1, ["p2"]) and seen["clients/c1/memory/m 1.md"][3:] == (3, ["clients", "c1", "memory"])


def test_second_write_changes_nothing(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "card_id string, text string")
    stored = spark.createDataFrame([("a", "1"), ("b", "status: approved\nold"), ("c", "old"), ("e", "x")], "card_id string, text string")
    first = M.upserts(new, stored)
    assert {r["card_id"]: r["outcome"] for r in first.collect()} == {"a": "unchanged", "b": "preserved", "c": "written", "d": "written"}
    assert {r["outcome"] for r in M.upserts(new.where("card_id <> 'd'"), first.select("card_id", "text")).collect()} == {"unchanged", "preserved"}
    assert {r["card_id"]: r["outcome"] for r in M.upserts(new, stored, force=True).collect()}["b"] == "written"
